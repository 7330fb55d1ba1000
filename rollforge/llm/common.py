"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import new_path


#: Folders of intermediate tables that this driver has written and not deleted.
_WRITTEN: list[str] = []


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back. The table is deleted by drop, sweep or when the driver ends."""
    spark = df.sparkSession
    if not _WRITTEN:
        atexit.unregister(_sweep_at_end)
        atexit.register(_sweep_at_end)
    path = new_path(spark, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rollforge_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(df: DataFrame) -> None:
    """Delete the table that materialize gave, where nothing needs it any more."""
    path = getattr(df, "_rollforge_path", None)
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        _delete(df.sparkSession, path)


def written() -> int:
    """A mark for sweep: how many intermediate tables there are."""
    return len(_WRITTEN)


def sweep(spark: SparkSession, since: int = 0, *, keep: DataFrame | None = None) -> None:
    """Delete the intermediate tables written since the mark, but for keep."""
    stay = [p for p in _WRITTEN[since:] if p == getattr(keep, "_rollforge_path", None)]
    gone = [p for p in _WRITTEN[since:] if p not in stay]
    _WRITTEN[since:] = stay
    for path in gone:
        _delete(spark, path)


def _sweep_at_end() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        try:
            sweep(spark)
        except Exception:  # the cluster may be gone before the driver; its folder then keeps the tables
            _WRITTEN.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind value once for body: a lambda over a one-element array, so an expensive expression isn't evaluated again for each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_HELD: dict[str, object] = {}


def hold(name: str, clear) -> None:
    """In a Python worker: the tables that operator `name` keeps from batch to batch may stay, those of operators that ran before in the worker go."""
    others = [n for n in _HELD if n != name]
    for other in others:
        _HELD.pop(other)()
    _HELD[name] = clear
    if others:  # give the memory back, since the worker shares its executor's
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)


def slices(batches, rows: int = 512):
    """Arrow batches cut small, so that few rows at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())
