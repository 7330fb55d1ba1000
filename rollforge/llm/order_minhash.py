"""Document fingerprints by order MinHash, with built-in expressions only.

Tokens are runs of up to MAX_TOKEN characters that aren't white space. The k-mers of k tokens are numbered by occurrence, so
each (k-mer, occurrence) is an item with a hash of its own. The range of hashes is cut at m places; from each place on the next l items are
taken, round the end of the range to its beginning, put back in text order, and that tuple is hashed. The fingerprint is the m tuple
hashes, likeness the share of equal ones. Every tuple of a text of l items or more holds l of them, however short the text is, so swapping passages
changes tuples of short texts as it does of long ones, and the likeness follows edit distance rather than the set of k-mers.
(One order of hashes with m places to begin stands for m orders; neighbouring places of a short text share tuples.)

A text of 2^20 tokens or more tells its k-mers apart by 33 bits of their hash, a shorter one by 44: k-mers that share them share occurrence numbers.

Per document: two sorts of primitive arrays and a few passes, no shuffle, no explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import let, materialize

K, M_BITS, L = 2, 6, 3
MAX_TOKEN = 8


def _shift(n: Column) -> Column:
    """Low bits that hold a place in the text: 20 up to a million tokens, else 31."""
    return F.when(n < (1 << 20), F.lit(20)).otherwise(F.lit(31))


def _high(h: Column, s: Column) -> Column:
    return F.call_function("shiftleft", F.call_function("shiftright", h, s), s)


def _low(x: Column, s: Column) -> Column:
    return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), s) - 1).cast("int")


def signature(text: Column, *, k: int = K, m_bits: int = M_BITS, l: int = L) -> Column:  # noqa: E741
    """array<int> of 2 ** m_bits tuple hashes; null for a text without tokens."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(rf"\S{{1,{MAX_TOKEN}}}"), F.lit(0)), lambda t: F.xxhash64(t))

    def of_tokens(t: Column) -> Column:
        n = F.greatest(F.size(t) - (k - 1), F.lit(1))
        kmer = lambda i: F.xxhash64(*[F.get(t, i + d) for d in range(k)])
        return F.when(F.size(t) > 0, let(F.transform(F.sequence(F.lit(0), n - 1), kmer), lambda h: of_kmers(h, _shift(F.size(h)))))

    def of_kmers(h: Column, s: Column) -> Column:
        by_kmer = F.sort_array(F.transform(h, lambda x, i: _high(x, s).bitwiseOR(i.cast("bigint"))))
        return let(by_kmer, lambda a: let(starts(a, s), lambda d: of_items(items(h, a, d, s), s)))

    def starts(a: Column, s: Column) -> Column:
        """Where in the sorted array the run of each k-mer begins, and the end."""
        first = lambda i: (i == 0) | (_high(F.get(a, i), s) != _high(F.get(a, i - 1), s))
        return F.concat(F.filter(F.sequence(F.lit(0), F.size(a) - 1), first), F.array(F.size(a)))

    def items(h: Column, a: Column, d: Column, s: Column) -> Column:
        """A hash and place for each occurrence; the hash's highest bits are its part."""

        def run(at: Column, j: Column) -> Column:
            one = lambda x, o: let(_low(x, s), lambda p: _high(F.xxhash64(F.get(h, p), o), s).bitwiseOR(p.cast("bigint")))
            return F.transform(F.slice(a, at + 1, F.get(d, j + 1) - at), one)

        return F.flatten(F.transform(F.slice(d, 1, F.size(d) - 1), run))

    def of_items(x: Column, s: Column) -> Column:
        return let(F.sort_array(x), lambda v: chosen(v, s))

    half = 1 << (m_bits - 1)
    part = lambda x: F.shiftright(x, 64 - m_bits).cast("int") + half  # noqa: E731  in the order of signed hashes

    def chosen(v: Column, s: Column) -> Column:
        """Of each part its first l items: no tuple needs others."""
        kept = F.filter(v, lambda x, i: (i < l) | (part(x) != part(F.get(v, F.greatest(i - l, F.lit(0))))))
        return let(kept, lambda c: let(F.concat(c, F.slice(c, F.lit(1), F.least(F.lit(l), F.size(c)))), lambda round_: let(firsts(c), lambda at: spread(c, round_, at, s))))

    def firsts(c: Column) -> Column:
        """Where the items of each filled part begin."""
        return F.filter(F.sequence(F.lit(0), F.size(c) - 1), lambda i: (i == 0) | (part(F.get(c, i)) != part(F.get(c, F.greatest(i - 1, F.lit(0))))))

    def spread(c: Column, round_: Column, at: Column, s: Column) -> Column:
        """A part's tuple also stands for the empty parts before it, the first one's for those behind the last."""
        tuples = F.transform(at, lambda i: tuple_of(c, round_, i, s))

        def of(t: Column) -> Column:
            gap = lambda j: part(F.get(c, F.get(at, j))) - F.when(j == 0, F.lit(-1)).otherwise(part(F.get(c, F.get(at, F.greatest(j - 1, F.lit(0))))))
            own = F.flatten(F.transform(t, lambda x, j: F.array_repeat(x, gap(j))))
            return F.concat(own, F.array_repeat(F.get(t, F.lit(0)), F.lit((1 << m_bits) - 1) - part(F.element_at(c, -1))))

        return let(tuples, of)

    def tuple_of(c: Column, round_: Column, i: Column, s: Column) -> Column:
        own = F.slice(round_, i + 1, F.least(F.lit(l), F.size(c)))
        # Text order: by place; the item's hash without its place is what is hashed.
        in_order = F.sort_array(F.transform(own, lambda x: F.struct(_low(x, s).alias("place"), F.shiftright(x, 31).alias("item"))))
        return F.shiftright(F.xxhash64(F.transform(in_order, lambda y: y["item"])), 32).cast("int")

    return let(tokens, of_tokens)


def fingerprint(text: Column, **settings) -> Column:
    """array<int> of 2 ** m_bits tuple hashes, all null for a text without tokens; null text counts as empty."""
    empty = F.array_repeat(F.lit(None).cast("int"), 1 << settings.get("m_bits", M_BITS))
    return F.coalesce(signature(F.coalesce(text, F.lit("")), **settings), empty)


def as_string(sig: Column) -> Column:
    """8 hex digits for each tuple, - for a null."""
    return F.array_join(F.transform(sig, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"), F.lit("-"))), ".")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal tuples; 1 for two texts without tokens, 0 where one has none."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(0), lambda n, same: n + same.cast("int")) / F.size(a)


def with_next(docs: DataFrame, columns: list[str], *, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """docs with next: the struct of columns of the row that follows in descending order of key (nulls last, rows of one key by the hash of their text, then the text; after the last: the first).

    Rows are cut at quantiles of key into many ranges; the first key of each range is also dealt, as a ghost, to
    the range before, so that each range finds its successors alone. A key that fills more than a range, and nulls, are cut by the hash of the text; a further pass
    over such rows alone finds their ranges' first rows. Rows of one key and text are one range however many they are. The driver holds a key for each range."""
    spark = docs.sparkSession
    parts = parts or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = F.col(key)
    quantiles = F.percentile_approx(key, [i / parts for i in range(1, parts)], F.lit(max(10_000, 4 * parts)))
    seen = docs.agg(quantiles.alias("q"), F.max(key).alias("top"), F.count(F.lit(1)).alias("n"), F.count(key).alias("known")).collect()[0]
    found = [*(seen.q or ()), *([] if seen.top is None else [seen.top])]
    ends = sorted(set(found), reverse=True)
    # Ranges go down from the top: those of ends[j] are, if it is hot, so many of its own rows, then one of keys below it, above ends[j + 1]; else one of both.
    hot = [found.count(e) if found.count(e) > (2 if e == seen.top else 1) else 0 for e in ends]
    base, special, at = [], [], 0
    for h in hot:
        base.append(at)
        special += range(at, at + h + 1) if h else ()
        at += h + 1 if h else 1
    nulls = max(1, -(-parts * (seen.n - seen.known) // seen.n)) if seen.n > seen.known else 0
    special += range(at, at + nulls)
    h = F.xxhash64(F.lit(7), text)
    share = lambda m: F.least(F.floor((h.cast("double") / F.lit(2.0**64) + 0.5) * m).cast("int"), (m - 1).cast("int"))
    own = F.lit(at) + share(F.lit(max(1, nulls)))  # of nulls
    if ends:
        held, steps = F.lit(ends), max(1, len(ends).bit_length())
        # Binary search for the last j with ends[j] >= key.
        j = F.aggregate(
            F.sequence(F.lit(steps - 1), F.lit(0), F.lit(-1)),
            F.lit(0),
            lambda j, b: let(j + F.call_function("shiftleft", F.lit(1), b), lambda up: F.when((up < len(ends)) & (F.get(held, up) >= k), up).otherwise(j)),
        )
        of = lambda j: let(F.get(F.lit(hot), j), lambda m: F.get(F.lit(base), j) + F.when(m == 0, F.lit(0)).when(F.get(held, j) == k, share(F.greatest(m, F.lit(1)))).otherwise(m))
        own = F.when(k.isNull(), own).otherwise(let(j, of))
    rows = docs.withColumn("__rf_r", own.cast("int"))
    order = F.struct((-k).alias("k"), h.alias("h"), F.col(text).alias("t"))
    firsts = None
    if special:
        firsts = rows.where(F.col("__rf_r").isin(special)).groupBy("__rf_r").agg(F.min_by(F.struct(*docs.columns), order).alias("first"))
        firsts = materialize(firsts, "firsts")
    filled = sorted({*range(at + nulls)} - set(special) | ({r["__rf_r"] for r in firsts.select("__rf_r").collect()} if firsts else set()))
    before = [0] * (at + nulls)
    for i, r in enumerate(filled):
        before[r] = filled[i - 1]
    back = F.get(F.lit(before or [0]), F.col("__rf_r"))
    starts = F.lit(False) if not ends else F.coalesce(F.array_contains(F.lit([e for e, x in zip(ends, hot, strict=True) if not x]).cast("array<bigint>"), k), F.lit(False)) if any(x == 0 for x in hot) else F.lit(False)
    deal = F.when(starts, F.array(F.struct(F.col("__rf_r").alias("r"), F.lit(False).alias("g")), F.struct(back.alias("r"), F.lit(True).alias("g")))).otherwise(F.array(F.struct(F.col("__rf_r").alias("r"), F.lit(False).alias("g"))))
    rows = rows.select(*docs.columns, F.explode(deal).alias("__rf_at")).select(*docs.columns, F.col("__rf_at.r").alias("__rf_r"), F.col("__rf_at.g").alias("__rf_g"))
    if firsts:
        rows = rows.union(firsts.select(*[F.col(f"first.{c}").alias(c) for c in docs.columns], back.alias("__rf_r"), F.lit(True).alias("__rf_g")))
    in_range = W.partitionBy("__rf_r").orderBy("__rf_g", F.desc_nulls_last(key), h, text)
    rows = rows.withColumn("next", F.lead(F.struct(*columns)).over(in_range))
    return rows.where("not __rf_g").select(*docs.columns, "next")


def compare_with_edits(docs: DataFrame, **settings) -> DataFrame:
    """For each row of docs (doc_id, text): the fingerprints of its text and of its edited text, and their likeness.

    The edited text has the last floor(n / 2) code points replaced by the first as many of the next document's. Null
    texts count as empty; rows of equal or null ids follow each other in the order of a hash of their texts; a single row is its own
    successor; an empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("sig", fingerprint(F.col("text"), **settings))
    rows = with_next(rows, ["text", "sig"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "sig", F.col("next.sig").alias("next_sig"), edited.alias("edited"))
    rows = rows.withColumn("edited_sig", fingerprint(F.col("edited"), **settings))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("sig")).alias("fingerprint"),
        as_string(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
