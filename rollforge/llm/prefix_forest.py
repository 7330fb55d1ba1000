"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives a vector a string of BITS signs: on which side of random hyperplanes it lies. A tree is the array of its vectors sorted by that string, so the
vectors that share a prefix with a query stand together. A query descends in each tree to the longest prefix
that it shares with anything, then ascends in all trees at once, a bit at a time, and takes in what shares the shorter prefixes. Ascending
stops when the k-th nearest so far is so near that a vector at its distance would already have been met in one of
the trees with probability `certainty`: signs of two vectors at angle t agree with probability 1 - t / pi, so at prefix length x
one of T trees has met it with probability 1 - (1 - (1 - t / pi) ** x) ** T. At prefix length 0 everything has been seen.

Equal vectors are one entry. Entries are dealt to cells by a hash prefix of their own, the signs on the sides of orthogonal hyperplanes, and a cell of more than
SHARD entries to shards; each shard holds its own forest. A query visits its own cell first. A vector in another cell is at least as far as the query is from the planes
between them, so in a second round the query goes to the cells alone that its k-th distance so far reaches (an exact bound), and the ascent in their forests ends when a vector at
that distance would have been met. The best of each shard meet in a last ranking. Queries come in blocks of QUERY_BLOCK, so a task's size is bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..shipping import ship
from .common import materialize

TREES, BITS, CERTAINTY = 48, 24, 0.95
SHARD, QUERY_BLOCK, SALTS = 16_384, 8_192, 64
#: Bits of a cell at most; beyond it cells are cut into more shards.
MAX_PREFIX = 20
SEED = 23


def cell_planes(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(dim, bits): orthonormal directions."""
    return np.linalg.qr(np.random.RandomState(seed + 1).standard_normal((dim, bits)))[0]


def cells_of(vectors: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(vectors), np.int64)
    for b, side in enumerate((vectors @ cell_planes(vectors.shape[1], bits)).T):
        out |= (side > 0).astype(np.int64) << b
    return out


def cells_within(vector: np.ndarray, bits: int, distance: float) -> np.ndarray:
    """The cells that hold vectors within distance, but for the vector's own: a cell is as far as the root of the sum of the squares of its distances to the planes between."""
    side = vector @ cell_planes(len(vector), bits)
    far, cells = np.zeros(1), np.zeros(1, np.int64)
    for b in range(bits):
        own = np.int64(side[b] > 0) << b
        far, cells = np.concatenate([far, far + side[b] ** 2]), np.concatenate([cells | own, cells | (own ^ np.int64(1 << b))])
        near = np.sqrt(far) <= distance * (1 + 1e-9) + 1e-12
        far, cells = far[near], cells[near]
    return cells[cells != cells_of(vector[None], bits)[0]]


def planes(dim: int, trees: int, bits: int, seed: int = SEED) -> np.ndarray:
    return np.random.RandomState(seed).standard_normal((dim, trees * bits))


class Forest:
    """Sorted arrays of hash strings over vectors (n, dim), for angles as seen from the origin."""

    def __init__(self, vectors: np.ndarray, *, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.vectors, self.trees, self.bits = np.asarray(vectors, np.float64), trees, bits
        self.norms = np.sqrt((self.vectors**2).sum(1))
        self.planes = planes(self.vectors.shape[1], trees, bits, seed)
        codes = self.codes(self.vectors)
        self.order = np.asfortranarray(np.argsort(codes, axis=0, kind="stable"))
        self.sorted = np.asfortranarray(np.take_along_axis(codes, self.order, 0))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(n, trees): each hash string as a number, its first sign in the highest bit."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for a in range(0, len(vectors), 4096):
            signs = (vectors[a : a + 4096] @ self.planes > 0).reshape(-1, self.trees, self.bits)
            for b in range(self.bits):
                out[a : a + 4096] = (out[a : a + 4096] << 1) | signs[:, :, b]
        return out

    def search(self, queries: np.ndarray, k: int, certainty: float, without: np.ndarray, within: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the nearest k entries found (and all ties with the k-th) and their distances; `without`: an entry to leave out, or -1; `within`: a distance beyond which none is needed."""
        out = []
        for a in range(0, len(queries), 256):
            some = np.asarray(queries[a : a + 256], np.float64)
            out += [self._ascend(q, k, certainty, w, r, lo, hi) for q, w, r, lo, hi in zip(some, without[a : a + 256], within[a : a + 256], *self._ranges(self.codes(some)), strict=True)]
        return out

    def _ranges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query, prefix length (0 to bits) and tree, the part of the sorted array that shares the prefix."""
        lo = np.empty((len(codes), self.bits + 1, self.trees), np.int64)
        hi = np.empty_like(lo)
        for t in range(self.trees):
            for x in range(self.bits + 1):
                shift = self.bits - x
                low = (codes[:, t] >> shift) << shift
                lo[:, x, t] = np.searchsorted(self.sorted[:, t], low)
                hi[:, x, t] = np.searchsorted(self.sorted[:, t], low + (1 << shift))
        return lo, hi

    def _ascend(self, query: np.ndarray, k: int, certainty: float, without: int, within: float, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, norm = len(self.vectors), float(np.sqrt((query**2).sum()))
        seen = np.zeros(n, bool)
        if without >= 0:
            seen[without] = True
        ids, far, found, kth = [], [], 0, float(within) ** 2
        # The descent ends at the longest prefix that all trees together share with k entries.
        deep = int(np.flatnonzero((hi - lo).sum(1) > k).max(initial=0))
        left = right = None
        for x in range(deep, -1, -1):
            mark = np.zeros(n, bool)
            for t in range(self.trees):
                if left is None:
                    mark[self.order[lo[x, t] : hi[x, t], t]] = True
                else:
                    mark[self.order[lo[x, t] : left[t], t]] = True
                    mark[self.order[right[t] : hi[x, t], t]] = True
            left, right = lo[x], hi[x]
            got = np.flatnonzero(mark & ~seen)
            if len(got):
                seen[got] = True
                ids.append(got)
                far.append(self.norms[got] ** 2 - 2 * (self.vectors[got] @ query) + norm * norm)
                found += len(got)
            if found >= k:
                kth = min(float(within) ** 2, float(np.partition(np.concatenate(far), k - 1)[k - 1]))
            if kth < np.inf and self._enough(norm, float(np.sqrt(max(kth, 0.0))), x, certainty):
                break
        if not ids:
            return np.empty(0, np.int64), np.empty(0)
        ids, far = np.concatenate(ids), np.concatenate(far)
        if kth < np.inf:  # distances proper for those that may be among the k nearest
            ids = ids[far <= kth + 1e-9 * (norm * norm + float(self.norms.max()) ** 2)]
        far = np.sqrt(((self.vectors[ids] - query) ** 2).sum(1))
        return ids, far

    def _enough(self, norm: float, distance: float, x: int, certainty: float) -> bool:
        """Whether a vector at this distance, at the widest angle that any norm here allows, has been met by prefixes of length x."""
        if x == 0:
            return True
        lo, hi = float(self.norms.min()), float(self.norms.max())
        sides = [lo, hi]
        if distance < norm:
            sides.append(min(max(np.sqrt(norm * norm - distance * distance), lo), hi))
        cosine = min((norm * norm + s * s - distance * distance) / (2 * norm * s) for s in sides)
        angle = np.arccos(min(1.0, max(-1.0, cosine)))
        agree = 1 - angle / np.pi
        return 1 - (1 - agree**x) ** self.trees >= certainty


def usable(table: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of rows whose vector is neither null nor zero and holds only finite numbers; of the commonest length (ties: the shorter)."""
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].dim if sizes else 0))


def _with_cells(entries: DataFrame, prefix: int) -> DataFrame:
    """entries (entry, v) with cell."""

    def run(batches):
        for batch in batches:
            v = batch.column("v")
            flat = v.flatten().to_numpy().reshape(len(v), -1) if len(v) else np.empty((0, 1))
            cells = cells_of(flat, prefix) if prefix and len(v) else np.zeros(len(v), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=["entry", "v", "cell"])

    ship(entries.sparkSession)
    return entries.select("entry", "v").mapInArrow(run, "entry bigint, v array<double>, cell bigint")


def _reached(asking: DataFrame, prefix: int) -> DataFrame:
    """A row of asking (entry, v, within) for each other cell that its distance reaches, with that cell."""

    def run(batches):
        for batch in batches:
            for i, (v, within) in enumerate(zip(batch.column("v").to_pylist(), batch.column("within").to_pylist(), strict=True)):
                cells = cells_within(np.array(v), prefix, within)
                if len(cells):
                    one = batch.take(pa.array([i] * len(cells), pa.int32()))
                    yield pa.RecordBatch.from_arrays([*one.columns, pa.array(cells)], names=["entry", "v", "within", "cell"])

    return asking.mapInArrow(run, "entry bigint, v array<double>, within double, cell bigint")


def search(table: DataFrame, *, k: int = 10, every: int = 100, certainty: float = CERTAINTY, trees: int = TREES, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, its k nearest others by Euclidean distance.

    Ties go to the smaller vec_id; a query with fewer candidates gets them all. Equal vectors are searched once and
    bring their k + 1 smallest ids, so a group of any size costs one entry. Repeated ids with one vector count once. Null, zero and non-finite vectors take no part; an
    empty table gives an empty result."""
    rows = materialize(usable(table), "vectors")
    # One entry for each vector: its smallest ids, first within salts, then over them.
    entry = F.xxhash64("v")
    salted = rows.select("vec_id", "v", entry.alias("entry"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("salt")).dropDuplicates(["vec_id", "entry"])
    first = salted.withColumn("at", F.row_number().over(W.partitionBy("entry", "salt").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    first = first.withColumn("at", F.row_number().over(W.partitionBy("entry").orderBy("vec_id"))).where(F.col("at") <= k + 1)
    members = materialize(first.select("entry", "vec_id", "at", "v"), "members")
    entries = members.where("at = 1").select("entry", "v")
    n = entries.count()
    dim = entries.select(F.size("v")).first()
    prefix = min(MAX_PREFIX, dim[0] if dim else 0, max(0, int(np.ceil(np.log2(max(1, n / shard))))))
    held = materialize(_with_cells(entries, prefix), "entries")
    sizes = held.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    sizes = materialize(sizes, "sizes")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", F.xxhash64("v").alias("entry")).distinct()
    asked = materialize(held.join(queries.select("entry").distinct(), "entry").select("entry", "v", "cell", F.lit(float("inf")).alias("within")), "asked")

    def visit(data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(ask):
            return pd.DataFrame({"asked": np.empty(0, np.int64), "entry": np.empty(0, np.int64), "score": np.empty(0)})
        data = data.sort_values("entry", ignore_index=True)
        names = data["entry"].to_numpy(np.int64)
        forest = Forest(np.array(data["v"].tolist(), np.float64), trees=trees, bits=bits)
        asks = ask["entry"].to_numpy(np.int64)
        at = np.minimum(np.searchsorted(names, asks), len(names) - 1)
        near = forest.search(np.array(ask["v"].tolist(), np.float64), k, certainty, np.where(names[at] == asks, at, -1), ask["within"].to_numpy(np.float64))
        sizes = [len(ids) for ids, _ in near]
        return pd.DataFrame({"asked": np.repeat(asks, sizes), "entry": names[np.concatenate([ids for ids, _ in near])], "score": np.concatenate([far for _, far in near])})

    def meet(asking: DataFrame) -> DataFrame:
        """What each of asking (entry, v, within, cell) finds in the shards of its cell."""
        blocks = asking.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")).join(sizes, "cell")
        blocks = materialize(blocks, "blocks")
        part = lambda c, parts: F.pmod(F.shiftright("entry", c), parts).cast("int")
        data = held.join(blocks, "cell").select("entry", "v", "cell", part(0, F.col("shards")).alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        given = asking.join(blocks, "cell").select("entry", "v", "within", "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), part(20, F.col("blocks")).alias("block"))
        by = ["cell", "shard", "block"]
        return materialize(data.groupBy(*by).cogroup(given.groupBy(*by)).applyInPandas(visit, "asked bigint, entry bigint, score double"), "met")

    ship(table.sparkSession)
    found = meet(asked)
    if prefix:
        # What the own cell gave bounds the rest: fewer than k entries, no bound.
        kth = F.get(F.sort_array(F.collect_list("score")), F.lit(k - 1))
        bound = found.groupBy("asked").agg(F.coalesce(kth, F.lit(float("inf"))).alias("within")).withColumnRenamed("asked", "entry")
        further = asked.drop("within").join(bound, "entry", "left").select("entry", "v", F.coalesce("within", F.lit(float("inf"))).alias("within"))
        found = found.union(meet(materialize(_reached(further, prefix), "reached")))
    # The query's own entry: copies of the query at distance 0.
    found = materialize(found.unionByName(asked.select(F.col("entry").alias("asked"), "entry", F.lit(0.0).alias("score"))), "found")
    best = found.withColumn("place", F.rank().over(W.partitionBy("asked").orderBy("score"))).where(F.col("place") <= k + 1)
    named = best.join(members.select("entry", F.col("vec_id").alias("vec_id")), "entry")
    # An entry asked by many queries is ranked once; each query then leaves itself out.
    top = named.withColumn("place", F.row_number().over(W.partitionBy("asked").orderBy("score", "vec_id"))).where(F.col("place") <= k + 1)
    top = materialize(top.select("asked", "vec_id", "score"), "top")
    lists = top.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    got = queries.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("asked")).join(lists, "asked")
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return got.select("query_id", F.posexplode(near).alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
