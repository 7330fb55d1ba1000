"""Row-wise comparison of two sets of numbered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def normalize_rows(df: DataFrame) -> DataFrame:
    """Columns in the order of their names, strings stripped."""
    kinds = dict(df.dtypes)
    return df.select(*[strip(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in sorted(df.columns)])


def record_diff(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """keys, field, actual, expected of each cell that differs, as strings; a row or a column that one side lacks differs in each cell that isn't null on the other."""
    fields = [*expected.columns, *(c for c in actual.columns if c not in expected.columns)]
    cell = lambda c, side, has: F.col(f"{side}.{c}").cast("string") if c in has.columns else F.lit(None).cast("string")
    joined = actual.alias("a").join(expected.alias("e"), keys, "full")
    cells = F.array(*[F.struct(F.lit(c).alias("field"), cell(c, "a", actual).alias("actual"), cell(c, "e", expected).alias("expected")) for c in fields if c not in keys])
    differing = F.filter(cells, lambda x: ~x["actual"].eqNullSafe(x["expected"]))
    return joined.select(*keys, F.inline(differing))


def mismatch_histogram(diff: DataFrame) -> DataFrame:
    return diff.groupBy("field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field")
