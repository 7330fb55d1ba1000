"""The queries and the pipeline's stages on the smallest tables."""

import collections
import hashlib
import math
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rollforge.llm import lattice_sampling, quality_ftrl, queries, secret_scan
from rollforge.llm.common import materialize, written

from .test_hash_operators import slow_classes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def test_registered():
    held = entry.queries()
    assert {n.split("_")[0] for n in held if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 11)}
    assert held["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    out = con.execute(queries.ORACLES[name])
    names = [d[0] for d in out.description]
    assert got == sorted(repr(tuple(dict(zip(names, r))[c] for c in columns)) for r in out.fetchall())


def plain_mix(rows):
    """Copies of each document by a plain inversion of the Poisson distribution."""
    n = collections.Counter(r["source"] or "" for r in rows)
    want = {k: math.sqrt(v) for k, v in n.items()}
    out = []
    for r in rows:
        k = r["source"] or ""
        rate, key = want[k] / sum(want.values()) * len(rows) / n[k], str(r["doc_id"])
        u = int(hashlib.md5(f"{corpus_pipeline.MIX_SEED}:0:{key}".encode()).hexdigest()[:13], 16) / 2**52
        copies, f = 0, math.exp(-rate)
        while f <= u:
            copies += 1
            f += math.exp(copies * math.log(rate) - rate - math.lgamma(copies + 1))
        out += [r["doc_id"]] * copies
    return out


def test_stages(spark):
    """Each stage on all that its predecessor kept, against a plain version; run() gives the same rows as its stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality_ftrl.train(docs, labels)
    columns, kept, rows = docs.columns, {}, [r.asDict() for r in docs.collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mix", "encode"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = [r.asDict() for r in docs.collect()]
    ids = lambda n: sorted(r["doc_id"] for r in kept[n])
    good = [r for r in rows if quality_ftrl.logistic(quality_ftrl.raw_score(quality_ftrl.features(r["text"]), weights)) >= quality_ftrl.CUT]
    assert ids("quality") == sorted(r["doc_id"] for r in good)
    good.sort(key=lambda r: r["doc_id"])
    first = slow_classes([r["text"] for r in good])
    assert ids("near_dedup") == [r["doc_id"] for i, r in enumerate(good) if first[i] == i]
    texts = {r["doc_id"]: r["text"] for r in good}
    assert {r["doc_id"]: r["text"] for r in kept["secrets"]} == {i: secret_scan.redact_text(texts[i]) for i in ids("near_dedup")}
    assert not any(secret_scan.find(r["text"])[0] for r in kept["secrets"])
    assert ids("mix") == sorted(plain_mix(kept["secrets"]))
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    with open(lattice_sampling.MODEL, "rb") as f:
        lattices = lattice_sampling.Lattices(lattice_sampling.Model(f.read()))
    want = collections.Counter()
    for r in kept["mix"]:
        for found in lattice_sampling.sample_batch(lattices, [r["text"]], [lattice_sampling.row_key(corpus_pipeline.SEGMENTATION_SEED, r["doc_id"])], corpus_pipeline.SEGMENTATIONS):
            want.update((r["doc_id"], i, tuple(x[0].tolist())) for i, x in enumerate(found, 1))
    assert collections.Counter((r.doc_id, r["sample"], tuple(r.ids)) for r in out) == want
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, out))
    assert all(r.round_trip for r in out)


def test_run_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    """Null, empty, long and repeated rows, columns of the operators' own names, documents or labels without rows."""
    labels = spark.createDataFrame([(7, 1, 0), (4, 0, 0), (None, 1, None), (6, None, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for name, documents, marks in (("odd", odd, labels), ("none", none, labels), ("unlabelled", odd, labels.where("false"))):
        documents.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        marks.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/odd")
        assert docs.columns == odd.columns
    before = written()
    for name in ("odd", "unlabelled"):
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert got.count() > 0
        assert got.where("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert written() <= before + 3  # the last stages' inputs
