"""URL filters: host and path rules, then a cascade of Bloom filters for a list of blocked keys.

The cascade holds a list exactly over a known universe of keys. Level 1 is a Bloom filter of the
listed keys; level 2 holds the unlisted keys that level 1 lets through; level 3 the listed keys that
level 2 lets through; and so on until a level lets nothing wrong through. A key of the universe is
listed if the first level that refuses it is even (or if none refuses it and the number of levels is odd).
Testing a key needs the filters alone: the list is never joined. Keys are dealt to shards by hash and each shard has its own filters, of a few hundred
bytes. While all filters together take LITERAL_BYTES or less there is one shard, and its filters are constants of the test's expression, without any join; beyond it
rows look their shard's filters up, and the filters are a table that nobody holds as a whole. Either way the same levels decide, so no size switches the method off.
Everything is built and tested with built-in expressions; bits are folded with bit_or before anything moves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: Filters of so many bytes in all are constants of an expression; beyond it a shard is made for each SHARD_KEYS listed keys.
LITERAL_BYTES, SHARD_KEYS = 1 << 20, 256
#: Keys between levels are written in so many files at least, and one more for each FILE_KEYS.
FILES, FILE_KEYS = 8, 500_000
#: Fixed values: (verdict, host, path) in the order of the contract.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path (up to ? or #); both empty for null or no ://."""
    known = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host = F.when(known, ascii_lower(F.regexp_extract(url, pattern, 1))).otherwise("")
    return host, F.when(known, F.regexp_extract(url, pattern, 2)).otherwise("")


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (ties: the first given) and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(enumerate(rules), key=lambda r: (-len(r[1][1] + r[1][2]), r[0]))
    for _, (said, h, p) in reversed(ranked):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _positions(key: Column, n_bits: int, k: int, seed: int) -> list[Column]:
    """k bit positions by double hashing."""
    a, b = F.xxhash64(F.lit(2 * seed), key), F.xxhash64(F.lit(2 * seed + 1), key)
    one, step = F.shiftrightunsigned(a, 2), F.shiftrightunsigned(b, 34).bitwiseOR(F.lit(1))
    return [F.pmod(one + step * i, F.lit(n_bits)) for i in range(k)]


def _sized(count: float, rate: float) -> tuple[int, int]:
    """Words of 64 bits and hash functions of a Bloom filter of count keys with false positives at about rate."""
    return max(1, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64)), max(1, round(-math.log2(rate)))


@dataclass
class Cascade:
    """The levels: words and hash functions of each shard's filter. One shard: its filters, as constants; more: a table (shard, w0, w1, ...: a filter's words, null without keys)."""

    shards: int
    sizes: list[tuple[int, int]] = field(default_factory=list)
    constants: list[Column] = field(default_factory=list)
    table: DataFrame | None = None

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(99), key), F.lit(self.shards)).cast("int")

    def words(self, level: int) -> Column:
        return self.constants[level] if self.shards == 1 else F.col(f"w{level}")

    def passes(self, key: Column, level: int) -> Column:
        n, k = self.sizes[level]
        test = F.lit(True)
        for at in _positions(key, n * 64, k, level):
            word = F.get(self.words(level), F.shiftright(at, 6).cast("int"))
            test = test & (F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return F.coalesce(test, F.lit(False))

    def is_listed(self, key: Column) -> Column:
        """Whether a key of the universe is on the list, in rows that with_filters gave."""
        out = F.lit(len(self.sizes) % 2 == 1)
        for i in reversed(range(len(self.sizes))):
            out = F.when(self.passes(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out

    def with_filters(self, rows: DataFrame, key: Column) -> DataFrame:
        """rows, with their shard's filters if they aren't constants."""
        return rows if self.shards == 1 or not self.sizes else rows.withColumn("shard", self.shard(key)).join(self.table, "shard", "left").drop("shard")


def build_level(keys: DataFrame, n: int, k: int, seed: int) -> DataFrame:
    """shard, word, bits: the words that aren't 0 of a Bloom filter of each shard's keys (shard, key)."""
    at = F.explode(F.array(*_positions(F.col("key"), n * 64, k, seed))).alias("at")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    return keys.select("shard", at).groupBy("shard", F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))


def filter_bytes(count: int, first_rate: float, rate: float, others: int) -> float:
    """Expected bytes of all levels for count listed keys and others unlisted ones."""
    per = lambda r: -math.log(r) / math.log(2) ** 2 / 8
    total, a, b, r = 0.0, float(count), float(others), first_rate
    for _ in range(64):
        total += a * per(r)
        a, b = b * r, a
        if a < 1:
            break
        r = rate
    return total


def build_cascade(universe: DataFrame, *, first_rate: float = 1 / 64, rate: float = 0.5, literal_bytes: int = LITERAL_BYTES, shard_keys: int = SHARD_KEYS) -> Cascade:
    """The levels over universe (key, listed: distinct keys).

    The first level takes first_rate, sized by how many unlisted keys there are to each listed one; the others rate."""
    sizes = {r.listed: r.n for r in universe.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed, others = sizes.get(True, 0), sizes.get(False, 0)
    first = min(rate, max(first_rate / 1024, listed * math.sqrt(first_rate) / max(1, others))) if others else rate
    small = filter_bytes(listed, first, rate, others) <= literal_bytes
    out = Cascade(1 if small else 1 << math.ceil(math.log2(max(2, listed / shard_keys))))
    side, count, rows = True, listed, listed + others
    held = universe.select("key", "listed", out.shard(F.col("key")).alias("shard"))
    while count:
        i = len(out.sizes)
        n, k = _sized(count / out.shards, first if not i else rate)
        words = build_level(held.where(F.col("listed") == side).select("shard", "key"), n, k, i)
        out.sizes.append((n, k))
        if out.shards == 1:
            bits = [0] * n
            for row in words.collect():  # LITERAL_BYTES in all, in one job
                bits[row.word] = row.bits
            out.constants.append(F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>"))  # folded to a constant by the optimizer
            tested = held
        else:
            by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
            filters = words.groupBy("shard").agg(by_word.alias("m")).select("shard", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.coalesce(F.try_element_at("m", j), F.lit(0).cast("bigint"))).alias(f"w{i}"))
            filters = materialize(filters, f"filters{i}")
            out.table = filters if out.table is None else out.table.join(filters, "shard", "left")  # a shard without keys in a level has none behind it
            tested = held.join(filters, "shard", "left")
        # What this level lets through of the other side is what the next level must hold; the rest is settled.
        side, seen = not side, Observation()
        tested = tested.where((F.col("listed") != side) | out.passes(F.col("key"), i)).select("key", "listed", "shard").coalesce(max(FILES, -(-rows // FILE_KEYS)))
        held = materialize(tested.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("listed") == side).alias("wrong")), f"cascade{i}")
        rows, count = seen.get["rows"], seen.get["wrong"]
    if out.table is not None:
        out.table = materialize(out.table, "filters")
    return out


def judge(pages: DataFrame, is_blocked, rules=RULES, **settings) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of pages (page_id, url); other columns are ignored, whatever their names.

    is_blocked: a Column expression of a key (host and path joined) that says whether the list holds it, or
    a DataFrame with a string column `key`. A page that no rule fits is blocked if its key is listed. Keys are
    judged once each. Null or malformed urls have the empty key, which belongs to the universe like any other;
    repeated rows stay; an empty table gives an empty result."""
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), F.concat("host", "path").alias("key"))
    keys = rows.select("key").distinct()
    if isinstance(is_blocked, DataFrame):
        listed = is_blocked.select("key").where(F.col("key").isNotNull()).distinct()
        universe = keys.join(listed.withColumn("listed", F.lit(True)), "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))
    else:
        universe = keys.select("key", is_blocked(F.col("key")).alias("listed"))
    cascade = build_cascade(materialize(universe, "keys"), **settings)
    hit = cascade.is_listed(F.col("key"))
    return cascade.with_filters(rows, F.col("key")).select("page_id", "host", "path", "rule", F.coalesce("said", F.when(hit, "block").otherwise("allow")).alias("verdict"))
