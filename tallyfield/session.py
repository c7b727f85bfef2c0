"""What a session needs besides its settings."""

from __future__ import annotations

import importlib.util
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Rows and bytes of an Arrow batch: texts are long, and a Python worker holds a batch several times over.
BATCH_ROWS, BATCH_BYTES = "2000", "8m"
_ARROW = "spark.sql.execution.arrow."


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package's code, which their Python workers import, unless the session has
    it already, and keeps Arrow batches small unless the session sets their size itself."""
    context = spark.sparkContext
    if spark.conf.get(_ARROW + "maxRecordsPerBatch") == "10000":
        spark.conf.set(_ARROW + "maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set(_ARROW + "maxBytesPerBatch", BATCH_BYTES)
    if getattr(context, "_tallyfield_shipped", False):
        return
    top = Path(importlib.util.find_spec("tallyfield").submodule_search_locations[0])
    archive = Path(tempfile.mkdtemp(prefix="tallyfield-")) / "tallyfield.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(str(archive))
    context._tallyfield_shipped = True


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's place below the one that the driver and all executors share; a temporary one only where none
    is set and everything runs on one machine."""
    top = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="tallyfield-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{top}/{name}-{uuid.uuid4().hex}"
