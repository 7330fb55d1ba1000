"""Page texts that arrive in a folder, as a stream.

Splitting and parsing hold no state. Serial numbers run over a whole document, so a document's pages must land in one batch to be numbered: write_numbered numbers each batch by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.records import parse_and_number, parse_pages
from ..sources.readers import PAGE_TEXT


def stream_pages(spark: SparkSession, folder: str, *, files_per_trigger: int = 1000) -> DataFrame:
    """PAGE_TEXT rows of Parquet files that land in folder."""
    return spark.readStream.schema(PAGE_TEXT).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def write_records(pages: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Records without serial numbers, exactly once, as Parquet; ends when what is there has been read."""
    return parse_pages(pages).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(output)


def write_numbered(pages: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Numbered records, a folder `batch=N` for each batch; a batch that is run again overwrites its own folder, so each record is there once."""

    def write(batch: DataFrame, number: int) -> None:
        parse_and_number(batch).write.mode("overwrite").parquet(f"{output.rstrip('/')}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
