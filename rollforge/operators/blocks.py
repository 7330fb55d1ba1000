"""Page text to person blocks: only the end marker separates them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import clean_lines, let, strip

MARKER = "VOTER_END"


def split_blocks(text: Column, marker: str = MARKER) -> Column:
    """array<string>: lines up to each line that holds the marker, with what else stands on that line. Empty blocks and what follows the last marker are dropped; null gives no block."""
    lines = clean_lines(F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), "\n"))

    def of(held: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.size(held)), lambda i: F.coalesce(F.contains(F.get(held, i), F.lit(marker)), F.lit(False)))
        return let(ends, lambda e: F.filter(F.transform(e, lambda end, k: block(held, end, F.when(k > 0, F.get(e, F.greatest(k - 1, F.lit(0))) + 1).otherwise(0))), lambda b: b != ""))

    def block(held: Column, end: Column, start: Column) -> Column:
        own = F.slice(held, start + 1, end - start)
        last = strip(F.replace(F.get(held, end), F.lit(marker), F.lit("")))
        return F.array_join(F.when(last != "", F.concat(own, F.array(last))).otherwise(own), "\n")

    return let(lines, of)
