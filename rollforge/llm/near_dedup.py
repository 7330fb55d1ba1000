"""Near-duplicate classes by order MinHash, verified by banded alignment.

Items are the runs of SHINGLE words of a text, numbered by occurrence. For each of BANDS hash orders the L smallest items are taken, put back
into text order and hashed to one key; texts that share a key are candidates. The alignment decides: a candidate pair is a link if the
similarity by edit distance of the words (1 - distance / words of the longer text) is `threshold` or more. Classes are the links' connected components.

Exact copies are joined first by a 128-bit digest, so only different texts meet, and texts travel as arrays of 32-bit hashes of their words. No pair becomes a row:
texts go to cells of bounded size, a cell compares its texts by itself, skips pairs that its links join already, and gives links only.

* A bucket (texts of one key) of up to SMALL texts is a cell; buckets of the same texts are one cell.
* A larger bucket names a hub, the text that shares keys with the most others (so the centre of a group of near copies). Each member is compared
  with its bucket's hub once, however many keys they share, in cells of about WORDS words.
* Members of a larger bucket that the links so far leave outside the hub's class are then compared with all its members of other classes, block by block: nothing is left out.
  A pair is tested in the first bucket that it shares only. Sizes and bags of words rule out pairs that can't be links before they are aligned; both bounds are exact.
  Tests grow with a bucket's members times those outside the hub's class.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .alignment import edit_similarity
from .common import drop, hold, materialize, slices

SHINGLE, THRESHOLD = 5, 0.8
BANDS, L, SMALL, WORDS = 16, 2, 8, 1 << 18

_G = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.RandomState(5)
_BAND = (_random.randint(0, 1 << 32, BANDS, np.uint64) << np.uint64(32) | _random.randint(0, 1 << 32, BANDS, np.uint64)) | np.uint64(1)
_BLOCK = 8192


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + _G
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words; cleared when it has grown."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        out = self[word] = zlib.crc32(raw) << 32 | zlib.adler32(raw[::-1], len(raw))
        return out


_WORDS = _Words()


def hashes_of(words: list[str]) -> np.ndarray:
    get = _WORDS
    return np.fromiter([get[w] for w in words], np.uint64, len(words))


def items_of(h: np.ndarray) -> np.ndarray:
    """Hashes of the occurrence-numbered shingles, in text order, of words' hashes; a text of fewer words than a shingle is one item, without words none."""
    if not len(h):
        return np.empty(0, np.uint64)
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, np.uint64(min(len(h), SHINGLE)))
    for d in range(min(SHINGLE, len(h))):
        out = _mix(out * _G ^ h[d : d + n])
    order = np.argsort(out, kind="stable")
    held = out[order]
    new = np.concatenate([[True], held[1:] != held[:-1]])
    if not new.all():
        at = np.arange(n)
        number = at - np.maximum.accumulate(np.where(new, at, 0))
        out[order] = np.where(number > 0, _mix(held ^ (number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), held)
    return out


def keys_of(items: np.ndarray) -> np.ndarray:
    """A key for each order: the hash of its L smallest items, in text order. No item, no key."""
    n = len(items)
    if not n:
        return np.empty(0, np.int64)
    best = None
    for a in range(0, n, _BLOCK):  # bounded memory for texts of any length
        x = items[a : a + _BLOCK]
        v = x[None, :] * _BAND[:, None]
        k = min(L, len(x))
        at = np.argpartition(v, k - 1, axis=1)[:, :k] if k < len(x) else np.broadcast_to(np.arange(len(x)), (BANDS, len(x)))
        v = np.take_along_axis(v, at, 1)
        at = at + a
        if best is not None:
            v, at = np.concatenate([best[0], v], 1), np.concatenate([best[1], at], 1)
            if v.shape[1] > L:
                keep = np.argpartition(v, L - 1, axis=1)[:, :L]
                v, at = np.take_along_axis(v, keep, 1), np.take_along_axis(at, keep, 1)
        best = v, at
    at = np.sort(best[1], axis=1)  # text order
    key = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for j in range(at.shape[1]):
        key = _mix(key * _G ^ items[at[:, j]])
    return key.astype(np.int64)


SKETCHED = "doc_id bigint, row bigint, node binary, keys array<bigint>, words array<int>"


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, kind), *parts])))


def sketch(rows: DataFrame) -> DataFrame:
    """SKETCHED for each of rows (doc_id, row, node, text): keys, one for each order, and the words' 32-bit hashes."""

    def run(batches):
        hold("words", _WORDS.clear)
        for batch in slices(batches, 256):
            keys, words = [], []
            for text in batch.column("text").to_pylist():
                h = hashes_of((text or "").split())
                keys.append(keys_of(items_of(h)))
                words.append((h >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "row", "node")), _lists(keys, np.int64), _lists(words, np.int32)], names=["doc_id", "row", "node", "keys", "words"])

    ship(rows.sparkSession)
    return rows.mapInArrow(run, SKETCHED)


def similar(a: str, b: str, threshold: float = THRESHOLD) -> bool:
    """Whether the alignment makes two texts near-duplicates."""
    return _near(a.split(), b.split(), threshold)


def _near(a: list, b: list, threshold: float) -> bool:
    return edit_similarity(a, b, threshold) >= threshold - 1e-9


class Classes:
    """Union of hashable names."""

    def __init__(self):
        self.up = {}

    def top(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x, y) -> None:
        self.up[self.top(y)] = self.top(x)


def _cells(batches):
    """Tables of the rows of one cell each, of batches in the order of cells."""
    held, current = [], None
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and cells[a] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = cells[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


LINK = "a binary, b binary"


def _links_of_cells(cells: DataFrame, compare) -> DataFrame:
    """The links (a, b) that compare(table) gives for each cell."""

    def run(batches):
        for cell in _cells(batches):
            if links := compare(cell):
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], names=["a", "b"])

    ship(cells.sparkSession)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, LINK)


def compare_small(cell: pa.Table, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links of a cell (node, hub, words): of its hub with each member, or without a hub of all its texts, as few as join them."""
    nodes, words, hub = cell["node"].to_pylist(), cell["words"].to_pylist(), cell["hub"].to_pylist()
    if any(hub):
        hubs = [i for i, x in enumerate(hub) if x]
        return [(nodes[h], nodes[i]) for h in hubs for i in range(len(nodes)) if nodes[i] != nodes[h] and _near(words[h], words[i], threshold)]
    found, out = Classes(), []
    for i in range(len(nodes)):
        for j in range(i):
            if nodes[i] != nodes[j] and found.top(i) != found.top(j) and _near(words[i], words[j], threshold):
                found.join(i, j)
                out.append((nodes[j], nodes[i]))
    return out


def _bag(words: np.ndarray) -> np.ndarray:
    """2048 bits, each the parity of the words that it stands for: two texts' bits differ in at most as many places as words are in one of them only."""
    odd = np.bincount(words.view(np.uint32) & np.uint32(2047), minlength=2048) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def compare_outside(cell: pa.Table, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links between the probes and the other rows of a cell (node, probe, out, comp, band, keys, words), as few as join their classes.

    A pair whose keys meet in an earlier order is left to that bucket, a pair of two probes to the probe with the smaller name."""
    nodes, probe = cell["node"].to_pylist(), np.array(cell["probe"].to_pylist(), bool)
    if not probe.any() or probe.all():
        return []
    comps, band = cell["comp"].to_pylist(), cell["band"][0].as_py()
    flat = cell["words"].combine_chunks()
    words = [np.asarray(x.values) for x in flat]
    n = np.array([len(w) for w in words], np.int64)
    bags = np.stack([_bag(w) for w in words])
    keys = np.array(cell["keys"].to_pylist(), np.int64)[:, :band]
    number = {c: i for i, c in enumerate(sorted(set(comps)))}
    comp = np.array([number[c] for c in comps])
    rank = np.empty(len(nodes), np.int64)
    rank[sorted(range(len(nodes)), key=nodes.__getitem__)] = np.arange(len(nodes))
    at, out = np.flatnonzero(~probe), np.array(cell["out"].to_pylist(), bool)
    found, links, as_list = Classes(), [], {}

    def lists(i: int) -> list:
        if i not in as_list:
            as_list[i] = words[i].tolist()
        return as_list[i]

    for p in np.flatnonzero(probe).tolist():
        most = np.floor((1 - threshold) * np.maximum(n[at], n[p]) + 1e-9)
        ok = (comp[at] != comp[p]) & (~out[at] | (rank[at] > rank[p])) & (np.abs(n[at] - n[p]) <= most)
        may = at[ok]
        if not len(may):
            continue
        # What is in one text only, both sides together; with the difference of sizes it gives the larger side.
        apart = np.bitwise_count(bags[may] ^ bags[p]).sum(1).astype(np.int64) + np.abs(n[may] - n[p])
        ok = (apart <= 2 * most[ok]) & ~(keys[may] == keys[p]).any(1)
        may, apart = may[ok], apart[ok]
        for q in may[np.argsort(apart, kind="stable")].tolist():
            if found.top(comps[p]) != found.top(comps[q]) and _near(lists(p), lists(q), threshold):
                found.join(comps[p], comps[q])
                links.append((nodes[p], nodes[q]))
    return links


def components(links: DataFrame) -> DataFrame:
    """node, comp (the smallest node that it reaches) for each node of links (a, b): smallest labels travel over links, and labels jump to their labels' labels."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")), "arcs")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = kept = materialize(labels.select("node", F.least("node", "low").alias("comp")), "labels")
    if labels.isEmpty():
        return labels
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        new = new.join(jump, new["comp"] == jump["via"], "left").select("node", "old", F.least("comp", "far").alias("comp"))
        new = materialize(new, "labels")
        drop(kept)
        labels, kept = new.select("node", "comp"), new
        if not new.where("comp < old").limit(1).count():
            return labels


def _blocks(total: Column) -> Column:
    return F.greatest(F.ceil(total / WORDS), F.lit(1)).cast("int")


def _block(node: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), node), blocks).cast("int")


def _first_links(shared: DataFrame, hubs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links inside small buckets, and of large buckets' members with their hubs."""
    small = shared.where(F.col("size") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all")).select("all").distinct()
    small = small.select(F.xxhash64("all").bitwiseAND(F.lit(-2)).alias("cell"), F.explode("all").alias("node"), F.lit(False).alias("hub"))
    led = shared.where(F.col("size") > SMALL).join(hubs, "key").where("node <> hub").select("hub", "node", "n").distinct()
    sizes = led.groupBy("hub").agg(_blocks(F.sum("n")).alias("blocks"))
    of = lambda block: F.xxhash64(F.lit(1), "hub", block).bitwiseOR(F.lit(1)).alias("cell")
    led = led.join(sizes, "hub").select(of(_block("node", F.col("blocks"))), "node", F.lit(False).alias("hub"))
    own = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select(of(F.col("block")), F.col("hub").alias("node"), F.lit(True).alias("hub"))
    cells = small.union(led).union(own).join(texts.drop("keys"), "node")
    return _links_of_cells(cells, lambda cell: compare_small(cell, threshold))


def _more_links(shared: DataFrame, hubs: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> DataFrame | None:
    """Links of members of large buckets that are outside their hub's class; None if there is no such member.

    Two members in different classes aren't both in the hub's class, so those outside it are met with all. Outsiders and members are
    dealt to blocks of about WORDS words; a cell holds a block of each."""
    named = hubs.join(labels.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp")), "hub", "left").select("key", F.coalesce("hub_comp", "hub").alias("hub_comp"))
    members = shared.where(F.col("size") > SMALL).join(labels, "node", "left").join(named, "key")
    members = members.select("key", "band", "node", "n", F.coalesce("comp", "node").alias("comp"), "hub_comp").withColumn("out", F.col("comp") != F.col("hub_comp")).drop("hub_comp")
    members = materialize(members, "members")
    sizes = members.groupBy("key").agg(_blocks(F.sum("n")).alias("blocks"), F.sum(F.when(F.col("out"), F.col("n"))).alias("out_n")).where("out_n is not null")
    sizes = materialize(sizes.select("key", "blocks", _blocks(F.col("out_n")).alias("out_blocks")), "sizes")
    if sizes.isEmpty():
        return None
    dealt = members.join(sizes, "key").select("*", _block("node", F.col("blocks")).alias("at"), _block("node", F.col("out_blocks")).alias("out_at"))
    kept = ["node", "comp", "out", "band"]
    targets = dealt.select("key", "at", F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)).alias("out_at"), F.lit(False).alias("probe"), *kept)
    probes = dealt.where("out").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), "out_at", F.lit(True).alias("probe"), *kept)
    cells = targets.unionByName(probes).select(F.xxhash64(F.lit(2), "key", "at", "out_at").alias("cell"), "probe", *kept)
    cells = cells.join(texts, "node")
    return materialize(_links_of_cells(cells, lambda cell: compare_outside(cell, threshold)), "links")


def classes(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class), class_size for each row of docs (doc_id, text).

    Exact copies, empty and null texts among them, are one class; a text without words is near to equal ones only, and a text of fewer than SHINGLE words to
    the same words. Repeated rows count as copies; rows without doc_id have the class's id, null if no row of it has one; an empty table
    gives an empty result; other columns are ignored."""
    return _classes(docs, threshold)[0].select("doc_id", "class_id", "class_size")


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, class_id, class_size, first: the class's row that stays), and the nodes with their class."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row(docs).alias("row"), _node(docs).alias("node"), "text")
    held = materialize(sketch(rows), "sketch")
    nodes = held.groupBy("node").agg(F.min("doc_id").alias("low"), F.min_by("row", F.struct(F.col("doc_id").isNull(), "row")).alias("row"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first(F.size("words")).alias("n"))
    nodes = materialize(nodes, "nodes")
    keyed = nodes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(keyed.join(counts, "key"), "shared")
    of = shared.select("node").distinct().join(nodes.select("node", "row"), "node")
    texts = held.select("row", "node", "keys", "words").join(of, ["row", "node"]).dropDuplicates(["node"])  # rows of one id and text are one
    texts = materialize(texts.drop("row"), "texts")
    large = shared.where(F.col("size") > SMALL)
    weights = large.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = materialize(large.join(weights, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("hub")), "hubs")
    links = materialize(_first_links(shared, hubs, texts, threshold), "links")
    labels = components(links)
    more = None if hubs.isEmpty() else _more_links(shared, hubs, labels, texts, threshold)
    if more is not None and not more.isEmpty():
        labels = components(links.union(more))

    of_class = nodes.select("node", "low", "row", "copies").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    summed = of_class.groupBy("comp").agg(F.min("low").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.struct(F.col("low").isNull().alias("none"), "row", "node")).alias("first"))
    summed = materialize(summed, "summed")  # behind a table the join is one that a large class's rows can be split in
    of_node = materialize(of_class.select("node", "comp").join(summed, "comp").select("node", "class_id", "class_size", "first"), "classes")
    return held.select("doc_id", "node").join(of_node, "node"), of_node


def deduplicate(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class: the one with the smallest doc_id (of rows with the same id and text, one)."""
    _, of_node = _classes(docs, threshold)
    stay = of_node.where(F.col("first.node") == F.col("node")).select(F.col("first.row").alias("__rf_row"), F.col("node").alias("__rf_node"))
    keyed = docs.withColumns({"__rf_row": _row(docs), "__rf_node": _node(docs)})
    return keyed.join(stay, ["__rf_row", "__rf_node"]).dropDuplicates(["__rf_row", "__rf_node"]).select(*docs.columns)


def _row(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("bigint"), F.xxhash64(F.lit(6), F.coalesce(docs["text"], F.lit(""))))


def _node(docs: DataFrame) -> Column:
    """A text's name: 128 bits of its SHA-256, so that no two different texts meet in practice (about 2 ** -61 for 2e10 documents)."""
    return F.unhex(F.substring(F.sha2(F.coalesce(docs["text"], F.lit("")), 256), 1, 32))
