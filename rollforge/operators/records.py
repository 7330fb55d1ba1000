"""Pages to numbered records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import detect_language
from .blocks import split_blocks
from .people import PERSON, parse_blocks

PAGE_KEYS = ("source_image", "doc_id", "assembly", "part_no", "street", "page_no")
#: A CSV file's columns in their order, and those that it leaves out.
CSV_COLUMNS = ("serial_no", "epic_id", "name", "father_name", "mother_name", "husband_name", "other_name", "age", "gender", "house_no", "street", "part_no", "assembly")
DROPPED = ("source_image", "ocr_text", "doc_id", "page_no", "voter_no")


def is_tamil(source_image: Column) -> Column:
    return F.coalesce(detect_language(source_image) == "tam+eng", F.lit(False))


def _with_blocks(pages: DataFrame, block_limit: int | None) -> DataFrame:
    blocks = split_blocks(F.col("ocr_text"))
    if block_limit is not None:
        blocks = F.slice(blocks, 1, max(block_limit, 1))
    return pages.withColumn("__blocks", blocks)


def parse_pages(pages: DataFrame, *, page_limit: int | None = None, block_limit: int | None = None) -> DataFrame:
    """A record for each block of pages (PAGE_KEYS and ocr_text): PERSON, PAGE_KEYS and block_pos. No block is dropped.

    page_limit: so many pages, by source_image. block_limit: so many blocks of each page, one at least."""
    if page_limit is not None:
        pages = pages.orderBy("source_image").limit(page_limit)
    held = _with_blocks(pages, block_limit).select(*PAGE_KEYS, F.posexplode("__blocks").alias("block_pos", "block"))
    held = held.withColumn("block_pos", F.col("block_pos").cast("bigint"))
    return parse_blocks(held, tamil=is_tamil(F.col("source_image"))).select(*PERSON, *PAGE_KEYS, "block_pos")


#: Columns of a written table of pages: a unique number, and how many blocks the page holds.
POSITION, N_BLOCKS = "position", "n_blocks"


def parse_and_number(pages: DataFrame, *, block_limit: int | None = None) -> DataFrame:
    """parse_pages with serial_no, which counts a document's records from 1 by page_no, source_image and block_pos (pages that share both: by their position, or their text).

    A page's records follow the records of the pages before it, so a window over pages carries their numbers of blocks. Of a written table of pages (with position and
    n_blocks) the window sees only keys and numbers, and the offset is joined back by position: no document's texts meet in a task, however many pages it has. Other pages move once, in
    one piece, to their document's task, and are read once, so they may come straight from a provider that never gives the same text twice. Records aren't moved."""
    if POSITION in pages.columns and N_BLOCKS in pages.columns:
        n = F.col(N_BLOCKS) if block_limit is None else F.least(F.col(N_BLOCKS), F.lit(max(block_limit, 1)))
        order = W.partitionBy("doc_id").orderBy("page_no", "source_image", POSITION).rowsBetween(W.unboundedPreceding, -1)
        before = pages.select(F.col(POSITION), F.coalesce(F.sum(n).over(order), F.lit(0)).alias("__before"))
        held = _with_blocks(pages.join(before, POSITION), block_limit)
    else:
        held = _with_blocks(pages, block_limit).select(*PAGE_KEYS, "__blocks")
        order = W.partitionBy("doc_id").orderBy("page_no", "source_image", "__blocks").rowsBetween(W.unboundedPreceding, -1)
        held = held.withColumn("__before", F.coalesce(F.sum(F.size("__blocks")).over(order), F.lit(0)))
    held = held.select(*PAGE_KEYS, "__before", F.posexplode("__blocks").alias("block_pos", "block"))
    held = held.withColumns({"block_pos": F.col("block_pos").cast("bigint"), "serial_no": (F.col("__before") + F.col("block_pos") + 1).cast("bigint")})
    return parse_blocks(held, tamil=is_tamil(F.col("source_image"))).select(*PERSON, *PAGE_KEYS, "block_pos", "serial_no")


def assign_serial_numbers(records: DataFrame) -> DataFrame:
    """records with serial_no, from 1 in each document by page_no, source_image and block_pos, where only records are at hand."""
    order = W.partitionBy("doc_id").orderBy("page_no", "source_image", "block_pos")
    return records.withColumn("serial_no", F.row_number().over(order).cast("bigint"))


def in_order(records: DataFrame) -> DataFrame:
    return records.orderBy("doc_id", "serial_no")


def parse_crops(items: DataFrame) -> DataFrame:
    """The older layout, one block for each row of items: PERSON overlaid with the items' own columns, which win."""
    item = F.struct(*[F.col(c) for c in items.columns]).alias("__item")
    parsed = parse_blocks(items.select(F.col("ocr_text").alias("block"), item))
    return parsed.select(*[c for c in PERSON if c not in items.columns], *[F.col(f"__item.{c}").alias(c) for c in items.columns])


def attach_headers(pages: DataFrame, headers: DataFrame, *, strict: bool = False) -> DataFrame:
    """pages (doc_id, page_no, ...) with header_text of headers (doc_id, page_no, header_text). strict: a page without a header fails the query."""
    out = pages.join(headers.select("doc_id", "page_no", "header_text"), ["doc_id", "page_no"], "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit("no header for page "), F.col("page_no").cast("string"), F.lit(" of "), F.col("doc_id")))
        out = out.withColumn("header_text", F.when(F.col("header_text").isNull(), missing.cast("string")).otherwise(F.col("header_text")))
    return out


def csv_projection(records: DataFrame) -> DataFrame:
    """CSV_COLUMNS that records has, then its other columns by name, without DROPPED."""
    extra = sorted(c for c in records.columns if c not in CSV_COLUMNS and c not in DROPPED and c != "block_pos")
    return records.select(*[c for c in CSV_COLUMNS if c in records.columns], *extra)
