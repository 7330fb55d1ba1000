"""Writers: CSV as one file in a fixed dialect, JSON with its nulls, Parquet as the primary form."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.records import csv_projection, in_order

CSV_NAME = "final_voter_data.csv"
#: CRLF, quotes only where needed and doubled inside, nulls blank.
CSV_DIALECT = {"header": True, "escape": '"', "nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\r\n", "encoding": "UTF-8"}


def write_csv(records: DataFrame, folder: str, *, single: bool = True) -> str:
    """Numbered records in order, in the fixed columns. single: one file CSV_NAME (rows pass through one task, as one file must); else a folder of parts."""
    out = csv_projection(in_order(records))
    parts = f"{folder.rstrip('/')}/{CSV_NAME}.parts"
    (out.coalesce(1) if single else out).write.mode("overwrite").options(**CSV_DIALECT).csv(parts)
    if not single:
        return parts
    spark = records.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{CSV_NAME}")
    fs = source.getFileSystem(conf)
    part = next(f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(source, True)
    return target.toString()


def write_json(records: DataFrame, path: str) -> None:
    """JSON lines, nulls written."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_parquet(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").parquet(path)
