"""Fingerprints, URL filters, segmentations, neighbours and near-duplicates against plain Python, with odd rows."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollforge.llm import lattice_sampling, near_dedup, order_minhash, prefix_forest, url_cascade
from rollforge.llm.alignment import banded_distance, edit_similarity

from .conftest import prose

# --- fingerprints ---


def slow_hash(spark, tokens, k):
    """k-mers of token hashes, by Spark's own hash."""
    rows = [(i, *(tokens[i + d] if i + d < len(tokens) else None for d in range(k))) for i in range(max(1, len(tokens) - k + 1))]
    df = spark.createDataFrame(rows, ", ".join(["i int", *(f"t{d} string" for d in range(k))]))
    return [r.h for r in df.select("i", F.xxhash64(*[F.xxhash64(f"t{d}") if d < 1 else F.when(F.col(f"t{d}").isNotNull(), F.xxhash64(f"t{d}")) for d in range(k)]).alias("h")).orderBy("i").collect()]


def slow_fingerprint(spark, text, k=order_minhash.K, m_bits=order_minhash.M_BITS, size=order_minhash.L):
    import re

    tokens = re.findall(r"\S{1,%d}" % order_minhash.MAX_TOKEN, text, re.A)
    if not tokens:
        return ".".join(["-"] * (1 << m_bits))
    kmers = slow_hash(spark, tokens, k)
    high = lambda h: h >> 20 << 20
    seen, numbered = collections.Counter(), []
    for p, h in enumerate(kmers):
        numbered.append((p, h, seen[high(h)]))
        seen[high(h)] += 1
    items = [(high(r.v) | r.p, r.p) for r in spark.createDataFrame(numbered, "p long, h long, o int").select("p", F.xxhash64("h", "o").alias("v")).collect()]
    items.sort()
    taken = []
    for j in range(1 << m_bits):
        start = (j << (64 - m_bits)) - (1 << 63)
        behind = [x for x in items if x[0] >= start] + [x for x in items if x[0] < start]
        taken.append((j, [v >> 31 for v, _ in sorted(behind[:size], key=lambda x: x[1])]))
    got = {r.part: (r.t >> 32) & 0xFFFFFFFF for r in spark.createDataFrame(taken, "part int, own array<long>").select("part", F.xxhash64("own").alias("t")).collect()}
    return ".".join(f"{got[i]:08x}" for i in range(1 << m_bits))


def test_fingerprints(spark):
    texts = ["", "one", "one two", "a b a b a b a b a b", prose(1, 200), "word" * 50, prose(2, 30) + " " + prose(2, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in order_minhash.compare_with_edits(docs).collect()}
    for i, t in enumerate(texts):
        after = texts[i - 1]  # descending ids; after the first, the last
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(t)
        assert got[i].fingerprint == slow_fingerprint(spark, t)
        assert got[i].edited_fingerprint == slow_fingerprint(spark, edited)


def test_fingerprints_follow_edits(spark):
    base = prose(5, 400).split()
    few, many, moved = list(base), list(base), base[200:] + base[:200]
    for i in range(0, 400, 80):
        few[i] = "changed"
    for i in range(0, 400, 8):
        many[i] = "changed"
    docs = spark.createDataFrame([(" ".join(base), " ".join(x)) for x in (base, few, moved, many, prose(6, 400).split())], "a string, b string")
    fp = order_minhash.fingerprint
    same, f, m, y, other = [r.v for r in docs.select(order_minhash.likeness(fp(F.col("a")), fp(F.col("b"))).alias("v")).collect()]
    assert same == 1
    assert 1 > f > y > other
    assert m < 0.5
    assert other < 0.1


@pytest.mark.parametrize("n", [40, 80, 400, 2000])
def test_likeness_follows_edit_distance(spark, n):
    """Rank correlation with the edit similarity of words, over substitutions, and the mean over exchanged halves and moved passages."""
    r, rows = random.Random(n), []
    for z in range(60):
        base = prose(n + z, n).split()
        own = list(base)
        for _ in range(r.randint(0, n // 4)):
            own[r.randrange(n)] = r.choice(base)
        rows += [("changed", base, own), ("halves", base, base[n // 2 :] + base[: n // 2]), ("tenth", base, base[n // 10 :] + base[: n // 10]), ("order", base, r.sample(base, n))]
    docs = spark.createDataFrame([(kind, " ".join(a), " ".join(b), edit_similarity(a, b, 0.01)) for kind, a, b in rows], "kind string, a string, b string, truth double")
    got = docs.select("kind", "truth", order_minhash.likeness(order_minhash.fingerprint(F.col("a")), order_minhash.fingerprint(F.col("b"))).alias("v")).collect()
    truth, near = (np.array([x[i] for x in got if x.kind == "changed"]) for i in (1, 2))
    rank = lambda x: np.array([(x < v).sum() + ((x == v).sum() - 1) / 2 for v in x])
    assert np.corrcoef(rank(truth), rank(near))[0, 1] >= 0.8
    mean = {kind: np.mean([x.v for x in got if x.kind == kind]) for kind in ("halves", "tenth", "order")}
    assert mean["halves"] < 0.3
    assert mean["order"] < 0.1
    assert mean["halves"] + 0.2 < mean["tenth"] < 0.9


@pytest.mark.parametrize("kind", ["one", "two", "many", "nulls", "hot", "one key", "hot top and nulls"])
def test_next_over_ranges(spark, kind):
    r = random.Random(len(kind))
    ids = {
        "one": [5],
        "two": [3, 9],
        "many": [None, None, *(r.randint(0, 30) for _ in range(57))],
        "nulls": [None] * 40,
        "hot": [*(r.randint(0, 400) for _ in range(60)), *[77] * 80],
        "one key": [4] * 50,
        "hot top and nulls": [*[900] * 60, *(r.randint(0, 900) for _ in range(40)), *[None] * 50],
    }[kind]
    rows = [(i, f"t{j % 40}") for j, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.with_next(docs, ["text"], parts=7).collect()
    order = [(x.doc_id, x.text) for x in docs.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64(F.lit(7), "text"), "text").collect()]
    want = sorted((str(a[0]), a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((str(x.doc_id), x.text, x.next.text) for x in got) == want


def test_fingerprints_odd(odd, none):
    got = order_minhash.compare_with_edits(odd).collect()
    assert len(got) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.doc_id in (7, 8)}) == 1
    assert order_minhash.compare_with_edits(none).count() == 0


# --- URL filters ---


def test_urls(spark):
    urls = ["http://A.example.COM/en/7/x?q#f", "https://example.com/en/8", "x://com/en/", "x://xcom/en/", "http://m.example.net/de/81", "http://b.net/de/", "http://o.org/es", "http://o.org/es/", "nothing", None, "", "a://b://c/d", "http://É.org/É?x", "http://u:p@h.org:80/es/x"]
    got = [tuple(r) for r in url_cascade.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), lambda k: F.lit(False)).orderBy("page_id").collect()]
    assert [g[1:4] for g in got] == [
        ("a.example.com", "/en/7/x", "example.com/en/7"),
        ("example.com", "/en/8", "com/en/"),
        ("com", "/en/", "com/en/"),
        ("xcom", "/en/", None),
        ("m.example.net", "/de/81", "example.net/de/8"),
        ("b.net", "/de/", "net/de/"),
        ("o.org", "/es", None),
        ("o.org", "/es/", "org/es/"),
        ("", "", None),
        ("", "", None),
        ("", "", None),
        ("b:", "//c/d", None),
        ("É.org", "/É", None),
        ("u:p@h.org:80", "/es/x", None),
    ]
    assert [g[4] for g in got] == ["allow", "block", "block", "allow", "block", "allow", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow"]


@pytest.mark.parametrize("literal_bytes", [1 << 20, 0])
@pytest.mark.parametrize("share", [0, 1, 5, 97, 100])
def test_cascade_is_exact(spark, share, literal_bytes):
    rows = [(f"key{i}", hash(("x", i)) % 100 < share) for i in range(3000)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    cascade = url_cascade.build_cascade(universe, literal_bytes=literal_bytes, shard_keys=16)
    assert (cascade.shards > 1) == (not literal_bytes and share > 0)
    assert cascade.with_filters(universe, F.col("key")).where(cascade.is_listed(F.col("key")) != F.col("listed")).count() == 0


def test_cascade_in_shards(spark):
    """One shard of constants or many of a table: the same rows, also with a key that a third of the rows have and columns of the operator's own names."""
    rows = [(i, f"http://h{i % 50}.xyz/{i % 7}", "x", 1) for i in range(400)] + [(9, None, None, 2)] + [(1000 + i, "no url", "y", 3) for i in range(200)] + [(8, "http://h3.xyz/" + "3" * 200_000, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, shard int").withColumns({"path": F.lit("p"), "rule": F.lit("r"), "key": F.lit("k"), "verdict": F.lit(1), "w0": F.lit(2)})
    blocked = spark.createDataFrame([("h3.xyz/3",), ("h3.xyz/3",), ("h4.xyz/1",), ("not there",), (None,)], "key string")
    a, b = (sorted(map(str, url_cascade.judge(pages, blocked, literal_bytes=m, shard_keys=1).collect())) for m in (1 << 20, 0))
    assert a == b
    assert len(a) == len(rows)
    assert {(r.host, r.path) for r in url_cascade.judge(pages, blocked).where("verdict = 'block'").collect()} == {("h3.xyz", "/3"), ("h4.xyz", "/1")}
    assert url_cascade.judge(pages.where("false"), blocked).count() == 0


# --- segmentations ---


@pytest.fixture(scope="module")
def lattices():
    with open(lattice_sampling.MODEL, "rb") as f:
        return lattice_sampling.Lattices(lattice_sampling.Model(f.read()))


def every_segmentation(model, text):
    symbols, out = model.symbols(text), {}

    def go(i, ids, lp):
        if i == len(symbols):
            out[tuple(ids)] = lp
            return
        single = False
        for n in range(1, model.longest + 1):
            p = model.ids.get(symbols[i : i + n]) if i + n <= len(symbols) else None
            if p is not None:
                single |= n == 1
                go(i + n, [*ids, p], lp + model.logp[p])
        if not single:
            go(i + 1, [*ids, *model.fallback(symbols[i])], lp + model.floor)

    go(0, [], 0.0)
    total = math.log(sum(math.exp(v) for v in out.values()))
    return {k: v - total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the in", "a  b", "x\n漢", "ing"])
def test_samples_follow_the_distribution(lattices, text):
    want, n, k = every_segmentation(lattices.model, text), 4000, 3
    got = lattice_sampling.sample_batch(lattices, [text] * n, [lattice_sampling.row_key(1, i) for i in range(n)], k)
    first, second, total = collections.Counter(), collections.Counter(), []
    for found in got:
        held = [tuple(x[0].tolist()) for x in found]
        assert len(set(held)) == len(held) == min(k, len(want))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:]))
        assert all(x[1] == pytest.approx(want[h], abs=1e-6) for x, h in zip(found, held))
        first[held[0]] += 1
        second[held[1]] += 1
        total.append(sum(math.exp(x[1]) / x[3] for x in found))
    assert np.mean(total) == pytest.approx(1, abs=0.02)  # the inclusion scores are unbiased weights
    for seg, lp in want.items():
        p = math.exp(lp)
        assert first[seg] / n == pytest.approx(p, abs=4 * math.sqrt(p * (1 - p) / n) + 2e-4)
        q = sum(math.exp(v) / (1 - math.exp(v)) * p for s, v in want.items() if s != seg)
        assert second[seg] / n == pytest.approx(q, abs=4 * math.sqrt(q * (1 - q) / n) + 2e-4)


def test_all_segmentations_come_out(lattices):
    want = every_segmentation(lattices.model, "of it")
    found = lattice_sampling.sample_batch(lattices, ["of it"], [5], 10_000)[0]
    assert {tuple(x[0].tolist()) for x in found} == set(want)
    assert all(x[3] == 1.0 for x in found)


def test_samples_don_t_depend_on_the_batch(lattices):
    texts = [prose(i, 60) for i in range(6)]
    keys = list(range(6))
    together = lattice_sampling.sample_batch(lattices, texts, keys, 3)
    fresh = lattice_sampling.Lattices(lattices.model)
    for t, key, found in zip(texts[::-1], keys[::-1], together[::-1]):
        alone = lattice_sampling.sample_batch(fresh, [t], [key], 3)[0]
        assert [(a[0].tolist(), a[1], a[2], a[3]) for a in alone] == [(b[0].tolist(), b[1], b[2], b[3]) for b in found]


def test_words_that_come_again_are_kept(lattices, monkeypatch):
    monkeypatch.setattr(lattice_sampling, "KEEP_ARCS", 3000)
    rng, held = random.Random(8), lattice_sampling.Lattices(lattices.model)
    once = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(40))
    texts = ["early words " + once() if i < 8 else "later sentences " + once() for i in range(40)] + ["early words later sentences " + "of it " * 9 + "z" * 60] * 3
    for i, text in enumerate(texts):
        key = lattice_sampling.row_key(3, i)
        got = lattice_sampling.sample_batch(held, [text], [key], 3)[0]
        held.settle()
        alone = lattice_sampling.sample_batch(lattices, [text], [key], 3)[0]
        assert [(x[0].tolist(), x[1:]) for x in got] == [(x[0].tolist(), x[1:]) for x in alone]
    assert held.arcs <= 3000 + 2000
    assert {"early", "words", "later", "sentences"} <= set(held.start)
    assert len(held.start) < 200 and not held.extra


def test_pieces_are_found_by_their_hashes(lattices):
    model, rng = lattices.model, np.random.default_rng(5)
    h = np.concatenate([model.hashes, model.hashes + np.uint64(1), model.hashes - np.uint64(1), rng.integers(0, 1 << 64, 10_000, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    assert np.array_equal(model.place(h), np.searchsorted(model.hashes, h))


def test_long_chunks_have_the_same_lattice(lattices):
    word = "internationalization" * 2
    a, b = lattice_sampling.Lattices(lattices.model), lattice_sampling.Lattices(lattices.model)
    a._add([word])
    b._add_long(word)
    assert np.array_equal(a.piece[: a.arcs], b.piece[: b.arcs])
    assert np.allclose(a.logp[: a.arcs], b.logp[: b.arcs])
    assert np.array_equal(a.target[: a.arcs], b.target[: b.arcs])


def test_chunks_make_up_the_text(lattices):
    for t in ["", "a b", " a", "a  b ", "  ", "x\u2581y z", "\n \n", prose(2, 30)]:
        assert "".join(lattice_sampling.SPACE + c for c in lattice_sampling.chunks(lattices.model, t)) == lattices.model.symbols(t)


def test_decode_is_the_models(lattices):
    model = lattices.model
    for t in ["", "a", " a  b ", "é\n漢\U0001f600\tx", prose(9, 50)]:
        ids = model.encode(t)
        assert model.decode(ids) == t == model.processor.decode(ids)


def test_decode_tables(odd, none):
    got = lattice_sampling.decode(lattice_sampling.sample(odd, k=2), into="back").collect()
    texts = collections.defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(r.text or "")
    assert all(r.back in texts[r.doc_id] for r in got)
    both = lattice_sampling.decode(lattice_sampling.encode(odd), into="key")
    assert sorted((r.text is None, r.text or "") for r in both.collect()) == sorted((r.key is None, r.key or "") for r in both.collect())
    assert set(both.columns) == {*odd.columns, "ids"}
    bad = odd.sparkSession.createDataFrame([([5, -1],), ([10**8],), ([None],), (None,), ([],)], "ids array<int>")
    assert [r.text for r in lattice_sampling.decode(bad).collect()] == [None, None, None, None, ""]
    assert lattice_sampling.decode(lattice_sampling.encode(none)).count() == 0


def test_segmentations_odd(odd, none):
    got = lattice_sampling.sample(odd, k=2).collect()
    assert all(r.round_trip for r in got)
    assert collections.Counter(r.doc_id for r in got)[4] == 2
    assert [(r.sample, r.ids, r.inclusion) for r in got if r.doc_id == 2] == [(1, [], 1.0)]
    assert sorted(map(str, got)) == sorted(map(str, lattice_sampling.sample(odd.repartition(1), k=2).collect()))
    assert lattice_sampling.sample(none).count() == 0


# --- neighbours ---


def vectors(n, dim, seed, scale=False):
    r = np.random.RandomState(seed)
    x = r.standard_normal((n, dim))
    x /= np.sqrt((x**2).sum(1))[:, None]
    return x * r.uniform(0.5, 3, (n, 1)) if scale else x


@pytest.mark.parametrize("scale", [False, True])
def test_neighbours_recall(spark, scale):
    x = vectors(3000, 16, 1, scale).astype(np.float32)
    x[100:140] = x[0]  # a group of copies larger than k
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = prefix_forest.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard=1000).collect()
    near = collections.defaultdict(dict)
    for r in got:
        near[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hit = total = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        want = sorted((d[i], i) for i in range(3000) if i != q)[:10]
        assert sorted(near[q]) == list(range(1, 11))
        assert all(s == pytest.approx(d[v], abs=1e-12) for v, s in near[q].values())
        if q in (0, 100):
            assert [near[q][i][0] for i in range(1, 11)] == [i for _, i in want]
        hit += len({v for v, _ in near[q].values()} & {i for _, i in want})
        total += 10
    assert hit / total >= 0.9


def test_cells_within_leave_none_out():
    x = vectors(2000, 8, 5, True)
    cells = prefix_forest.cells_of(x, 5)
    for q in range(0, 2000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        for r in (0.3, 0.8, 2.0, np.inf):
            reached = set(prefix_forest.cells_within(x[q], 5, r).tolist()) | {int(cells[q])}
            assert set(cells[d <= r].tolist()) <= reached
    assert len(prefix_forest.cells_within(x[0], 5, 0.0)) == 0


def test_clusters_visit_few_cells(spark):
    """Clustered vectors: recall over many cells, one of them far too large for a shard."""
    r = np.random.RandomState(3)
    centres = vectors(30, 16, 9) * 4
    x = np.concatenate([centres[r.randint(0, 30, 2000)] + 0.05 * r.standard_normal((2000, 16)), centres[0] + 0.01 * r.standard_normal((1000, 16))])
    got = prefix_forest.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), shard=200).collect()
    hit = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hit += len({g.vec_id for g in got if g.query_id == q} & set(np.argsort(d)[:10].tolist()))
    assert len(got) == 300
    assert hit / 300 >= 0.9


def test_neighbours_odd(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "a"), (100, [0.0, 1.0], "a"), (200, [0.0, 0.0], "a"), (300, None, None), (400, [nan, 1.0], "b"), (500, [inf, 0.0], "b"), (600, [None, 1.0], "b"), (700, [1.0], "b"), (1, [1.0, 0.0], "b"), (1, [1.0, 0.0], "b"), (None, [1.0, 1.0], "c"), (800, [], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in prefix_forest.search(df).collect())
    root = math.sqrt(2)
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 100), (100, 1, 0), (100, 2, 1)]
    assert [g[3] for g in got] == pytest.approx([0, root, root, root])
    assert prefix_forest.search(df.where("false")).count() == 0


# --- near-duplicates ---


def test_banded_distance():
    r = random.Random(3)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    for _ in range(4000):
        a = [r.randint(0, 2) for _ in range(r.randint(0, 14))]
        b = list(a) if r.random() < 0.6 else [r.randint(0, 2) for _ in range(r.randint(0, 14))]
        for _ in range(r.randint(0, 4)):
            if b and r.random() < 0.5:
                b.pop(r.randrange(len(b)))
            else:
                b.insert(r.randint(0, len(b)), r.randint(0, 3))
        m = r.randint(0, 8)
        assert banded_distance(a, b, m) == min(slow(a, b), m + 1)
    assert edit_similarity([], [], 0.8) == 1.0
    assert edit_similarity(list("abcde"), list("abcdx"), 0.8) == 0.8


def corpus():
    r = random.Random(8)
    texts = []
    for g in range(12):
        base = prose(100 + g, r.randint(60, 300)).split()
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 40) if g else 60):
            own = list(base)
            for _ in range(max(1, len(base) // r.randint(45, 90))):
                own[r.randrange(len(own))] = f"w{r.randint(0, 10**6)}"
            texts.append(" ".join(own))
        texts.append(" ".join(base[len(base) // 2 :] + base[: len(base) // 2]))  # moved halves
        texts.append(" ".join(base[: len(base) // 2] + prose(500 + g, len(base)).split()))  # half shared
    shared = prose(77, 60)
    texts += [prose(900 + i, 40) + " " + shared + " " + prose(950 + i, 40) for i in range(25)]
    texts += ["a b c", "a b c", "a b d", "one two three four five six", "one two three four five six seven", "", ""]
    r.shuffle(texts)
    return texts


def keys_of(text):
    return near_dedup.keys_of(near_dedup.items_of(near_dedup.hashes_of(text.split()))).tolist()


def joined(n, links):
    """For each of n texts the smallest that links reach."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        parent[b] = a
    return {i: find(i) for i in range(n)}


def slow_classes(texts):
    """All pairs that share a key, each aligned."""
    keys = [set(keys_of(t)) for t in texts]
    return joined(len(texts), ((i, j) for i in range(len(texts)) for j in range(i) if texts[i] == texts[j] or (keys[i] & keys[j] and near_dedup.similar(texts[i], texts[j]))))


def test_classes_match_all_pairs(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_dedup.classes(docs).collect()}
    assert {i: c for i, (c, _) in got.items()} == slow_classes(texts)
    sizes = collections.Counter(c for c, _ in got.values())
    assert all(sizes[c] == n for c, n in got.values())
    kept = near_dedup.deduplicate(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for c, _ in got.values()})


def test_small_cells_give_the_same(spark, monkeypatch):
    """Blocks of few words and no small bucket: the same classes."""
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(str, near_dedup.classes(docs).collect()))
    monkeypatch.setattr(near_dedup, "WORDS", 1500)
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    assert sorted(map(str, near_dedup.classes(docs).collect())) == want


def test_recall_against_true_edit_similarity(spark):
    """Copies with up to 15 in 100 words substituted, left out or put in; the truth aligns all pairs, without keys."""
    r = random.Random(12)
    texts = []
    for g in range(60):
        base = prose(700 + g, r.choice([60, 120, 200, 400])).split()
        texts.append(" ".join(base))
        for rate in (0.02, 0.05, 0.1, 0.15):
            own = []
            for w in base:
                x = r.random()
                own += [w] if x > rate else [[f"w{r.randint(0, 10**6)}"], [], [w, "more"]][r.randint(0, 2)]
            texts.append(" ".join(own))
    truth = joined(len(texts), ((i, j) for i in range(len(texts)) for j in range(i) if near_dedup.similar(texts[i], texts[j])))
    got = {x.doc_id: x.class_id for x in near_dedup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(truth[i] == truth[got[i]] for i in truth)  # no false link
    again = [i for i in truth if truth[i] != i]
    assert len(again) > 150
    assert sum(got[i] != i for i in again) / len(again) >= 0.9


def vary(words, n, seed, same=True):
    """words with n of them changed so that the keys stay; with same=False then one more, so that some key doesn't."""
    r, words = random.Random(seed), list(words)
    keys = keys_of(" ".join(words))
    done = 0
    while done < n + (not same):
        own = list(words)
        own[r.randrange(len(own))] = f"v{r.randint(0, 10**9)}"
        if (keys == keys_of(" ".join(own))) == (done < n):
            words, done = own, done + 1
    return words


def assert_exact(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    want = slow_classes([" ".join(t) for t in texts])
    assert {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()} == want
    return want


def test_pairs_that_share_large_buckets_only(spark):
    """Loners with the same keys, and among them pairs of near copies without the hub."""
    base = prose(41, 400).split()
    texts = [vary(base, 90, i) for i in range(60)]
    pairs = [vary(base, 90, 100 + i) for i in range(6)]
    want = assert_exact(spark, texts + pairs + [vary(t, 1, 200 + i) for i, t in enumerate(pairs)])
    assert all(want[66 + i] == 60 + i for i in range(6))
    assert len(set(want.values())) == 66


def test_leftovers_meet_behind_a_loner(spark):
    """A large group of near copies, and outside it a heavy loner and two near copies of each other."""
    base = prose(42, 400).split()
    parent = vary(base, 100, 1)
    texts = [vary(base, 1, 10 + i) for i in range(25)] + [vary(base, 100, 2), vary(parent, 0, 3, same=False), vary(parent, 0, 4, same=False)]
    want = assert_exact(spark, texts)
    assert [want[i] for i in (24, 25, 26, 27)] == [0, 25, 26, 26]


def test_similarity_sees_order():
    base = prose(1, 200).split()
    assert near_dedup.similar(" ".join(base), " ".join(base[:150] + ["x"] + base[150:]))
    assert not near_dedup.similar(" ".join(base), " ".join(base[100:] + base[:100]))


def test_long_text_keys_don_t_depend_on_blocks(monkeypatch):
    items = near_dedup.items_of(near_dedup.hashes_of(prose(4, 3000).split()))
    a = near_dedup.keys_of(items)
    monkeypatch.setattr(near_dedup, "_BLOCK", 100)
    assert np.array_equal(a, near_dedup.keys_of(items))


def test_near_dedup_odd(odd, none):
    got = near_dedup.classes(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert (by[7], by[8], by[9], by[1], by[4]) == (7, 7, 7, 1, 4)
    assert by[2] == by[3] == 2  # empty and null
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "5", "6", "7", "None"]
    assert near_dedup.classes(none).count() == 0
    assert near_dedup.deduplicate(none).count() == 0
