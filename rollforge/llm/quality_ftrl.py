"""A quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Tokens are runs of word characters and runs of other visible characters. Features are the hashed tokens, token shapes (case, digits,
accents and length class of a word; marks stand for themselves) and the pairs of both; a token that
repeats the one before it forms the pair `same`. A document's vector is the mean of its features' indicators, so
its score is the logistic of a sparse dot product: the mean of the weights at its hashed places.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import hold, slices

BITS = 18
#: A classifier is fitted on at most so many labelled documents: those with the smallest hashes of their ids.
MAX_TRAIN = 12_000
#: Their sparse vectors may hold so many entries together (8 bytes each); the documents that would pass it, in the order of the hashes, are left out.
MAX_ENTRIES = 1 << 25
SCALE = 8.0  # a vector's entries sum to this for each kind of feature
CUT = 0.3  # of the score; at or above it a document is kept
TOKEN = re.compile(r"\w+|[^\w\s]+")


def _shape(token: str) -> str:
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:4]
    case = "X" if token.isupper() and len(token) > 1 else "x" if token.islower() else "T" if token.istitle() else "9" if token.isdigit() else "m"
    return f"{case}{min(len(token), 24) // 6}"


class _Hashes(dict):
    """Token -> its hash (high 32 bits) and its shape's (low 32 bits); cleared when it has grown."""

    def __missing__(self, token: str) -> int:
        if len(self) > 100_000:
            self.clear()
        out = self[token] = (zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) << 32) | zlib.crc32(b"\x00" + _shape(token).encode("utf-8", "surrogatepass"))
        return out


_HASHES = _Hashes()
_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    x = (a * _M + b + np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)


def features(text: str | None) -> np.ndarray:
    """Hashed places, with repeats: four for each token. The empty text has none."""
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.empty(0, np.int64)
    get = _HASHES
    h = np.fromiter([get[t] for t in tokens], np.uint64, len(tokens))
    word, shape = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
    before = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
    same = word == before
    pair = np.where(same, np.uint64(7), before)
    this = np.where(same, np.uint64(7), word)
    shape_before = np.concatenate([np.zeros(1, np.uint64), shape[:-1]])
    zero = np.zeros_like(word)
    return np.concatenate([_mix(zero, word, 1), _mix(pair, this, 2), _mix(zero, shape, 3), _mix(shape_before, shape, 4)]).astype(np.int64)


def raw_score(places: np.ndarray, weights: np.ndarray) -> float:
    """The dot product; the last weight is the bias."""
    return float(weights[-1] + (weights[places].sum(dtype=np.float64) * (4 * SCALE / len(places)) if len(places) else 0.0))


def logistic(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (int32, ascending) and values (float32) of a text's sparse vector; the last entry is the bias."""
    places, counts = np.unique(features(text), return_counts=True)
    total = max(1, counts.sum())
    return np.append(places, 1 << BITS).astype(np.int32), np.append(counts * (4 * SCALE / total), 1.0).astype(np.float32)


def fit(vectors: list[tuple[np.ndarray, np.ndarray, float]], *, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 1e-5, l2: float = 1e-5) -> np.ndarray:
    """Weights (2 ** BITS and a bias) after FTRL-proximal updates over vectors (places, values, label), in the order given."""
    n = (1 << BITS) + 1
    z, g2, weights = np.zeros(n), np.zeros(n), np.zeros(n)
    for _ in range(epochs):
        for places, x, y in vectors:
            w = weights[places]
            g = (logistic(float(w @ x)) - y) * x
            sigma = (np.sqrt(g2[places] + g * g) - np.sqrt(g2[places])) / alpha
            z[places] += g - sigma * w
            g2[places] += g * g
            zi = z[places]
            weights[places] = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(g2[places])) / alpha + l2))
    return weights.astype(np.float32)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, max_entries: int = MAX_ENTRIES, **settings) -> np.ndarray:
    """Weights from docs (doc_id, text) and labels (doc_id, quality), held-out rows apart.

    Sparse vectors are made in parallel; one task gets at most max_train of them and max_entries entries, and makes the updates, which follow each other.
    A document labelled twice gets the majority (ties: 1); null labels don't count. Without any labelled document all weights are 0."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    order = F.xxhash64(F.lit(8), "doc_id")
    known = known.select("doc_id", "quality", order.alias("at")).orderBy("at", "doc_id").limit(max_train)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # known: max_train rows at most

    def vectors(batches):
        hold("features", _HASHES.clear)
        for batch in slices(batches):
            held = [vector(t) for t in batch.column("text").to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(p) for p, _ in held)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, k), *(h[i] for h in held)]))) for i, k in ((0, np.int32), (1, np.float32))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("at", "doc_id", "tie", "quality")), *lists], names=["at", "doc_id", "tie", "quality", "places", "counts"])

    def run(batches):
        rows, entries = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                places, values = (batch.column(c)[i].values.to_numpy().copy() for c in ("places", "counts"))
                entries += len(places)
                if len(rows) < max_train and entries <= max_entries:
                    rows.append((places, values, float(batch.column("quality")[i].as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([fit(rows, **settings).tobytes()], pa.binary())], names=["weights"])

    ship(docs.sparkSession)
    sample = sample.select("at", F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "quality", "text")
    made = sample.mapInArrow(vectors, "at bigint, doc_id bigint, tie bigint, quality int, places array<int>, counts array<float>")
    got = made.repartition(1).sortWithinPartitions("at", "doc_id", "tie").mapInArrow(run, "weights binary").collect()
    return np.frombuffer(bytes(got[0].weights), np.float32) if got else np.zeros((1 << BITS) + 1, np.float32)


SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def score(docs: DataFrame, weights: np.ndarray, *, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score (that label 1 fits), predicted for each row of docs (doc_id, text). Null and empty texts get the bias's score."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(weights)  # 1 MB

    def run(batches):
        hold("features", _HASHES.clear)
        w = held.value
        for batch in slices(batches):
            got = np.array([logistic(raw_score(features(t), w)) for t in batch.column("text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(got), pa.array((got >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, weights: np.ndarray, *, cut: float = CUT) -> DataFrame:
    """The rows of docs whose score is at least cut, with their columns as they are, whatever their names. Null and empty texts get the bias's score; repeated rows
    are judged alike; an empty table stays empty."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        hold("features", _HASHES.clear)
        w = held.value
        for batch in slices(batches):
            good = [logistic(raw_score(features(t), w)) >= cut for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
