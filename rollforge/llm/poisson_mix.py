"""Mixing sources to target weights by Poisson replication.

A source with n documents and target share w of a corpus of T documents gets the rate w * T / n. Each document's
number of copies is the Poisson variate of that rate that a uniform number, hashed from seed and row key, inverts
to: the number of k with F(k) <= u. Copies are dealt over the whole result by a second hash: it is uniform, so equal ranges of it are
partitions of equal size, and sorting each sorts the whole; no pass over the data samples bounds first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize

#: Sources' tables of so many bytes in all are broadcast; beyond it they are joined by salted keys.
MAX_BROADCAST_BYTES = 8 << 20
SALTS = 64
#: Bits of shuffle_key, and the largest number that is inverted.
KEY_BITS, MOST = 60, 1 - 2.0**-52


def hashed_uniform(key: Column, seed: int, salt: str) -> Column:
    """In [0, 1), of 52 bits, from the MD5 of seed, salt and key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{salt}:"), key)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def log_factorial(k: Column) -> Column:
    """ln k!: exact up to 20, above by Stirling's series (error under 1e-12)."""
    x = k.cast("double")
    series = x * F.ln(x) - x + F.ln(x * 6.283185307179586) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(k <= 20, F.ln(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def source_rates(docs: DataFrame, *, weights: dict[str, float] | None = None, alpha: float = 0.5, total: int | None = None) -> DataFrame:
    """source, n, rate. weights: target shares by source (a source that isn't named gets 0); without them
    the share is in proportion to n ** alpha. total: rows of the mixture, all documents' number if None. Counts cover all documents."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights:
        known = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, float(v))])
        want = F.coalesce(F.try_element_at(known, F.col("source")), F.lit(0.0))
    else:
        want = F.pow(F.col("n").cast("double"), F.lit(alpha))
    counts = counts.withColumn("want", want)
    sums = counts.agg(F.sum("want").alias("all_want"), F.sum("n").alias("all_n")).collect()[0]  # one row
    goal = float(total if total is not None else sums.all_n or 0)
    return counts.select("source", "n", (F.col("want") / F.lit(float(sums.all_want or 1.0)) * goal / F.col("n")).alias("rate"))


def with_tables(rates: DataFrame) -> DataFrame:
    """Add cdf: F(0), F(1), ... as far as a number can reach them, and parts.

    A table ends where F passes the largest number, or behind the rate where a step is below 2 ** -56. At rate 1 it holds about 18 entries. Rates
    above 600 are cut into equal parts, whose variates are summed, so a table has at most about 800 entries."""
    parts = F.ceil(F.col("rate") / 600.0).cast("int")
    part = F.col("rate") / F.greatest(parts, F.lit(1))
    k = rates.select("source", "n", "rate", F.greatest(parts, F.lit(1)).alias("parts"), part.alias("part"))
    k = k.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("part") + 12 * F.sqrt("part") + 30).cast("int"))).alias("k"))
    pmf = F.when(F.col("part") > 0, F.exp(F.col("k") * F.ln("part") - F.col("part") - log_factorial(F.col("k")))).otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    k = k.withColumn("p", pmf).withColumn("f", F.sum("p").over(W.partitionBy("source").orderBy("k")))
    reached = (F.col("k") == 0) | ((F.col("f") <= MOST) & ((F.col("k") <= F.col("part")) | (F.col("p") >= 2.0**-56)))
    return k.where(reached).groupBy("source", "n", "rate", "parts").agg(F.sort_array(F.collect_list("f")).alias("cdf"))


def copies_of(key: Column, cdf: Column, parts: Column, seed: int) -> Column:
    """The Poisson variate of the row: the sum over parts of how many k have F(k) <= u."""
    one = lambda u: F.size(F.filter(cdf, lambda f: f <= u))
    first = one(hashed_uniform(key, seed, "0"))
    more = F.aggregate(F.sequence(F.lit(1), parts - 1), F.lit(0), lambda acc, p: acc + F.size(F.filter(cdf, lambda f: f <= F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), p.cast("string"), F.lit(":"), key)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52)))))
    return F.when(parts > 1, first + more).otherwise(first)


def mix(docs: DataFrame, *, weights: dict[str, float] | None = None, alpha: float = 0.5, total: int | None = None, seed: int = 17, shuffle: bool = True) -> DataFrame:
    """The columns of docs, each row as often as drawn, with copy (from 1), n_copies and shuffle_key, sorted by shuffle_key over all partitions.

    docs needs doc_id and source; columns of docs named copy, n_copies or shuffle_key are replaced. Null
    source: a source of its own (as the empty name); null doc_id: the text, if there is one, is the key. Equal keys draw equal counts. Rows of rate 0
    leave. An empty table gives an empty result."""
    spark_cols = [c for c in docs.columns if c not in ("copy", "n_copies", "shuffle_key")]
    rates = with_tables(source_rates(docs, weights=weights, alpha=alpha, total=total))
    rates = materialize(rates.select(F.col("source").alias("__rf_source"), F.col("cdf").alias("__rf_cdf"), F.col("parts").alias("__rf_parts")), "rates")
    rows = docs.select(*spark_cols, F.coalesce("source", F.lit("")).alias("__rf_source"))
    size = rates.agg(F.sum(F.octet_length("__rf_source") + 8 * F.size("__rf_cdf") + 64)).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        rows = rows.join(F.broadcast(rates), "__rf_source")
    else:
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        dealt = rates.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("__rf_salt"))
        rows = rows.withColumn("__rf_salt", salt).join(dealt, ["__rf_source", "__rf_salt"])
    unnamed = F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))) if "text" in docs.columns else F.lit("null")
    key = F.coalesce(F.col("doc_id").cast("string"), unnamed)
    rows = rows.withColumn("n_copies", copies_of(key, F.col("__rf_cdf"), F.col("__rf_parts"), seed).cast("int")).where("n_copies > 0")
    rows = rows.select(*spark_cols, "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    order = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:order:"), key, F.lit(":"), F.col("copy").cast("string"))), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    rows = rows.select(*spark_cols, "copy", "n_copies", order.alias("shuffle_key"))
    if not shuffle:
        return rows
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = KEY_BITS // 2
    place = F.shiftright(F.shiftright("shuffle_key", half) * F.lit(parts), half).cast("int")
    return rows.repartitionById(parts, place).sortWithinPartitions("shuffle_key")
