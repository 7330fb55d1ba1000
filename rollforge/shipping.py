"""Python workers import this package; a zip of it goes to every executor, once for a session's context."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_MARK = "_rollforge_shipped"
#: Rows of an Arrow batch, where neither the session nor the context sets a number. Whole documents are long: Spark's 10,000 rows would be tens of MB for each task, in the JVM and in Python.
BATCH_ROWS, _ROWS, _DEFAULT = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Make the package importable on executors, wherever the driver found it, and keep Arrow batches small unless the user has chosen their size."""
    context = spark.sparkContext
    if spark.conf.get(_ROWS) == _DEFAULT and not context.getConf().contains(_ROWS):
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    if getattr(context, _MARK, False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="rollforge-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "rollforge.zip")
    with zipfile.ZipFile(target, "w") as out:
        for where, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(where, name)
                out.write(path, os.path.join("rollforge", os.path.relpath(path, here)))
    context.addPyFile(target)
    setattr(context, _MARK, True)
