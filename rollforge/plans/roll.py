"""The whole run: PDFs or page texts to a table of pages, and from it to numbered records and files.

The table of pages is written once and everything behind it reads the table, so pages are rasterised and read once, whatever a provider gives next time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import split_blocks
from ..operators.records import N_BLOCKS, POSITION, in_order, parse_and_number
from ..sources import readers, sinks
from ..sources.ocr import DPI, OcrProvider, PageRasterizer, page_rows, rasterize, read_pages


@dataclass
class Config:
    input: str | list[str]
    output: str
    headers: str | None = None
    limit: int | None = None
    dpi: int = DPI
    strict_headers: bool = True
    single_csv: bool = True
    keep_images: bool = False


@dataclass
class Result:
    """Paths of a run's tables and its counts: pages, blank and failed ones, pages without a header, records."""

    csv: str
    counts: dict = field(default_factory=dict)


def records_of_texts(spark: SparkSession, texts: str, headers: str | None, *, limit: int | None = None, strict: bool = True) -> DataFrame:
    """Numbered records of a folder of page texts and one of headers."""
    pages = readers.page_text(readers.scan_page_texts(spark, texts, limit=limit), readers.scan_headers(spark, headers) if headers else None, strict=strict)
    return parse_and_number(pages)


def pages_of_pdfs(spark: SparkSession, config: Config, rasterizer: PageRasterizer, provider: OcrProvider) -> DataFrame:
    """doc_id, page_no, lang, header_text, ocr_text, error (and image, if kept) of a folder or list of PDFs, from one run of rasteriser and OCR."""
    images = rasterize(readers.scan_pdfs(spark, config.input, limit=config.limit), rasterizer, dpi=config.dpi)
    return read_pages(images.repartition("doc_id", "page_no"), provider, keep_images=config.keep_images)


def write_pages(pages: DataFrame, path: str) -> tuple[DataFrame, dict]:
    """Write the table of pages, each with its position (a unique number) and its number of blocks; the table, and how many pages there are, are blank, failed or without a header."""
    pages = pages.withColumns({POSITION: F.monotonically_increasing_id(), N_BLOCKS: F.size(split_blocks(F.col("ocr_text")))})
    seen = Observation("pages")
    none = F.col("error").isNull()
    counts = {"pages": F.lit(True), "failed_pages": ~none, "blank_pages": none & (F.coalesce("ocr_text", F.lit("")) == ""), "pages_without_header": none & (F.coalesce("header_text", F.lit("")) == "")}
    pages.observe(seen, *[F.count_if(test).alias(name) for name, test in counts.items()]).write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.schema(pages.schema).parquet(path), seen.get


def records_of_pdfs(spark: SparkSession, config: Config, rasterizer: PageRasterizer, provider: OcrProvider) -> tuple[DataFrame, DataFrame, dict]:
    """(numbered records, failed pages, counts) of PDFs, by way of the table of pages at output/pages."""
    pages, counts = write_pages(pages_of_pdfs(spark, config, rasterizer, provider), f"{config.output.rstrip('/')}/pages")
    good, failed = page_rows(pages)
    return parse_and_number(readers.page_text(good)), failed, counts


def write_all(records: DataFrame, config: Config, failed: DataFrame | None = None) -> Result:
    """Parquet with all columns, JSON lines, the CSV file and the failed pages; records are made once, the other files read the Parquet."""
    base, seen = config.output.rstrip("/"), Observation("records")
    sinks.write_parquet(records.observe(seen, F.count(F.lit(1)).alias("records")), f"{base}/records")
    held = records.sparkSession.read.parquet(f"{base}/records")
    sinks.write_json(in_order(held), f"{base}/json")
    if failed is not None:
        sinks.write_json(failed, f"{base}/failed")
    return Result(sinks.write_csv(held, f"{base}/csv", single=config.single_csv), seen.get)


def run_texts(spark: SparkSession, config: Config) -> Result:
    return write_all(records_of_texts(spark, config.input, config.headers, limit=config.limit, strict=config.strict_headers and bool(config.headers)), config)


def run_pdfs(spark: SparkSession, config: Config, rasterizer: PageRasterizer, provider: OcrProvider) -> Result:
    records, failed, counts = records_of_pdfs(spark, config, rasterizer, provider)
    result = write_all(records, config, failed)
    result.counts = {**counts, **result.counts}
    return result
