"""Readers. All paths go to Spark, so any store that Spark reads will do (comma-separated lists too)."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import parse_any_header, parse_file_name
from ..functions.text import S, detect_language

PAGE_TEXT = "source_image string, ocr_text string, doc_id string, assembly string, part_no bigint, street string, page_no bigint"


def paths_of(uris: str | list[str]) -> list[str]:
    """Paths of a comma-separated list."""
    return [u.strip() for u in uris.split(",") if u.strip()] if isinstance(uris, str) else list(uris)


def _glob(suffix: str) -> str:
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix.lstrip("."))


def _names(spark: SparkSession, folder: str | list[str], glob: str) -> DataFrame:
    """path, name of the files that a glob matches. Contents aren't read: no column asks for them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths_of(folder))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def _first(names: DataFrame, limit: int) -> DataFrame:
    """The paths of the first so many names (ties by path)."""
    return names.orderBy("name", "path").limit(limit).select("path")


def scan_files(spark: SparkSession, folder: str | list[str], suffix: str, *, limit: int | None = None) -> DataFrame:
    """path, name, content of the files with a suffix (in any case), in no order: contents are never sorted. limit: the first so many by name; 0 gives none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", _glob(suffix)).load(paths_of(folder))
    files = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files if limit is None else files.join(_first(_names(spark, folder, _glob(suffix)), limit), "path", "left_semi")


def scan_pdfs(spark: SparkSession, folder: str | list[str], *, limit: int | None = None) -> DataFrame:
    return scan_files(spark, folder, "pdf", limit=limit)


def scan_images(spark: SparkSession, folder: str | list[str], *, suffix: str = "jpg", limit: int | None = None) -> DataFrame:
    return scan_files(spark, folder, suffix, limit=limit)


def has_text(column) -> F.Column:
    return F.coalesce(~column.rlike(rf"\A{S}*\z"), F.lit(False))


def scan_page_texts(spark: SparkSession, folder: str, *, limit: int | None = None) -> DataFrame:
    """name, ocr_text, doc_id, page_no of `*.txt` files with text and a page's name. limit: the first so many files by name; 0 or None: all."""
    texts = spark.read.option("pathGlobFilter", _glob("txt")).text(paths_of(folder), wholetext=True)
    texts = texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("ocr_text"))
    texts = texts.withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))
    if limit:
        # Both readers' paths without their schemes' slashes: file:/x and file:///x.
        plain = lambda c: F.regexp_replace(c, "^([A-Za-z0-9]+):/*", "$1:/")
        first = _first(_names(spark, folder, _glob("txt")), limit).select(plain(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("__path"))
        texts = texts.join(first, plain(F.col("path")) == F.col("__path"), "left_semi")
    texts = texts.where(has_text(F.col("ocr_text"))).withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("at", parse_file_name(F.col("name")))
    return texts.where("at is not null").select("name", "ocr_text", "at.doc_id", "at.page_no")


def scan_headers(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, page_no, header_text of `<doc>_page_<n>_street.txt` files."""
    texts = spark.read.option("pathGlobFilter", "*_street.txt").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("header_text"))
    at = parse_file_name(F.replace(F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B"))), F.lit("_street"), F.lit("_stacked_ocr")))
    return texts.withColumn("at", at).where("at is not null").select("at.doc_id", "at.page_no", "header_text")


def page_text(texts: DataFrame, headers: DataFrame | None = None, *, strict: bool = False) -> DataFrame:
    """PAGE_TEXT of texts (name, ocr_text, doc_id, page_no), with the fields of each page's header, and position and n_blocks if texts have them."""
    from ..operators.records import N_BLOCKS, POSITION, attach_headers

    if headers is None:
        texts = texts.withColumn("header_text", F.lit(None).cast("string")) if "header_text" not in texts.columns else texts
    else:
        texts = attach_headers(texts, headers, strict=strict)
    held = texts.withColumn("h", parse_any_header(F.col("header_text"), detect_language(F.col("name")) == "tam+eng"))
    return held.select(F.col("name").alias("source_image"), "ocr_text", "doc_id", "h.assembly", "h.part_no", "h.street", "page_no", *[c for c in (POSITION, N_BLOCKS) if c in texts.columns])


def load_page_json(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(PAGE_TEXT).json(path, multiLine=multi_line)


def load_csv_folder(spark: SparkSession, files: list[str]) -> DataFrame:
    """All files joined by column name, missing columns null; no file gives an empty frame without columns.

    One pass finds each file's first line; files of the same header are one read, so the plan grows with the kinds of headers, not with the files."""
    files = sorted(f for f in files if f.endswith(".csv"))
    if not files:
        return spark.createDataFrame([], "struct<>")
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    heads = lines.where("at = 0").groupBy("path").agg(F.first("value").alias("head"))  # a file's first block is read by one task, in order
    kinds = heads.groupBy("head").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("head").collect()
    frames = [spark.read.csv([unquote(p) for p in k.paths], header=True, escape='"', multiLine=True) for k in kinds]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else spark.createDataFrame([], "struct<>")


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Files of a folder in any store that Hadoop reads."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().toString() for f in found if f.isFile())
