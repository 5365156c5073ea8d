"""Make this package importable on the executors, whatever path the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()
#: Rows go to Python in batches of so many bytes, or of one row.  Without a limit a
#: batch is 10,000 texts, of which the JVM and the worker each hold several copies.
_BATCH_BYTES, _BATCH_CONF = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors through Spark, once an application.

    Bounds the bytes of Arrow batches, unless the session does."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, _BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
