"""The corpus pipeline: documents to sampled token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's rows as Parquet to the folder that the cluster shares and reads them back for the next; what a stage wrote on its way is deleted behind it.

Documents may have further columns, whatever their names; they pass through all stages but the last. Tables may be empty: the result then is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollforge.llm import lattice_sampling, near_dedup, poisson_mix, quality_ftrl, secret_scan
from rollforge.llm.common import drop, materialize, sweep, table, written

#: The target mixture: sources in proportion to the square root of their size, over as many rows as come in.
MIX_ALPHA, MIX_SEED = 0.5, 17
#: Sampled segmentations of each document.
SEGMENTATIONS, SEGMENTATION_SEED = 2, 11


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labels of rows that aren't held out; null and empty texts are scored like others (by the bias); without
    labels every document stays (score 0.5); repeated rows are judged alike."""
    return quality_ftrl.keep(docs, quality_ftrl.train(docs, table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the smallest doc_id (rows without one last; ties: one row). Null and empty texts are copies of each other."""
    return near_dedup.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, and n_chars counts the new text; every document stays, null and empty texts as they are."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out by their source's rate, and shuffled. A null source is a source of its own; a row without doc_id is drawn by its text."""
    return poisson_mix.mix(docs, alpha=MIX_ALPHA, seed=MIX_SEED).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each row: SEGMENTATIONS, or all if there are fewer; null and empty texts have one, without pieces."""
    return lattice_sampling.sample(docs, k=SEGMENTATIONS, seed=SEGMENTATION_SEED)


STAGES = [
    ("quality", quality),
    ("near_dedup", dedup),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]
#: SQL can't express the classifier, the classes or the sampled segmentations; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark, before = written(), docs
        docs = materialize(stage(spark, before, sf_dir), name)
        sweep(spark, mark, keep=docs)
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
