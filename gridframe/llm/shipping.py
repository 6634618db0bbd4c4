"""Makes this package importable by Python workers, whatever folder the driver was started in."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application.

    Rows here are whole texts, so a batch that goes to a Python worker holds at
    most ``BATCH_ROWS`` of them, which bounds what JVM and worker hold at a time.
    """
    if int(spark.conf.get(BATCH_SETTING)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "gridframe_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
