"""The command line: PDFs, or page texts, to numbered records.

spark-submit rollforge/cli.py --input-folder PDFS --rasterizer MODULE:NAME --provider MODULE:NAME --output OUT
spark-submit rollforge/cli.py --texts TEXTS --headers HEADERS --output OUT
"""

from __future__ import annotations

import argparse
import importlib
import logging
import os
import sys
import time

if not __package__:  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from rollforge.operators import diff
from rollforge.plans.roll import Config, run_pdfs, run_texts
from rollforge.sources import sinks

#: What --regression finds in its folder beside the PDFs.
EXPECTED = "expected_" + sinks.CSV_NAME
TABLES = ("pages", "records", "json", "failed", "csv")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Scanned rolls to numbered records")
    p.add_argument("--input-folder", default="pdf", help="folder of PDFs, in any store that Spark reads")
    p.add_argument("--input", help="comma-separated list of PDFs or folders, in place of --input-folder")
    p.add_argument("--texts", help="folder of page texts, in place of PDFs")
    p.add_argument("--headers", help="folder of header texts, with --texts")
    p.add_argument("--output", default="csv", help="where all tables and files go, in any store that Spark writes")
    p.add_argument("--rasterizer", help="module:name of a page rasteriser (called without arguments)")
    p.add_argument("--provider", help="module:name of an OCR provider (called without arguments)")
    p.add_argument("--delete-old", action="store_true", help="delete what an earlier run wrote")
    p.add_argument("--regression", metavar="FOLDER", help=f"read FOLDER's PDFs (or FOLDER/texts and FOLDER/headers) and compare the CSV file with FOLDER/{EXPECTED}; the exit code is 1 if they differ")
    p.add_argument("--max-workers", type=int, help="tasks at a time, where no master is set")
    p.add_argument("--limit", type=int, help="so many files")
    p.add_argument("--dpi", type=int, default=Config.dpi)
    p.add_argument("--keep-images", action="store_true", help="page images stay in the table of pages")
    p.add_argument("--lenient", action="store_true", help="page texts without a header stay, with nulls")
    p.add_argument("--parts", action="store_true", help="a folder of CSV parts in place of one file")
    return p


def load(name: str | None, what: str):
    if not name:
        raise SystemExit(f"--{what} MODULE:NAME is needed for PDFs")
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def delete_old(spark: SparkSession, output: str) -> None:
    for name in TABLES:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{output.rstrip('/')}/{name}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def compare(spark: SparkSession, actual: str, expected: str) -> DataFrame:
    """Cells that differ between two CSV files: row (from 1, by place), field, actual, expected."""

    def rows(path):
        held = diff.normalize_rows(spark.read.csv(path, header=True, escape='"', multiLine=True))  # one file of several lines a cell is one task, so ids count rows
        return held.coalesce(1).withColumn("row", _row_number())

    return diff.record_diff(rows(actual), rows(expected), ["row"])


def _row_number():
    from pyspark.sql import functions as F

    return F.monotonically_increasing_id() + 1


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    builder = SparkSession.builder.appName("rollforge")
    if args.max_workers and SparkSession.getActiveSession() is None and not os.environ.get("MASTER"):
        builder = builder.config("spark.master", f"local[{args.max_workers}]")
    spark, began = builder.getOrCreate(), time.perf_counter()
    if args.delete_old:
        delete_old(spark, args.output)
    texts, headers, folder = args.texts, args.headers, args.regression
    if folder and exists(spark, f"{folder}/texts"):
        texts, headers = f"{folder}/texts", f"{folder}/headers" if exists(spark, f"{folder}/headers") else None
    config = Config(texts or folder or args.input or args.input_folder, args.output, headers=headers, limit=args.limit, dpi=args.dpi, strict_headers=not args.lenient, single_csv=not args.parts, keep_images=args.keep_images)
    result = run_texts(spark, config) if texts else run_pdfs(spark, config, load(args.rasterizer, "rasterizer"), load(args.provider, "provider"))
    logging.info("%s in %.1f s", ", ".join(f"{v} {k.replace('_', ' ')}" for k, v in result.counts.items()), time.perf_counter() - began)
    if not folder:
        return 0
    cells = compare(spark, result.csv, f"{folder}/{EXPECTED}").persist()
    for r in cells.orderBy("row", "field").limit(50).collect():
        logging.error("row %d, %s: %r, expected %r", r["row"], r.field, r.actual, r.expected)
    wrong = diff.mismatch_histogram(cells).collect()
    cells.unpersist()
    for r in wrong:
        logging.error("%s: %d", r.field, r.n)
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
