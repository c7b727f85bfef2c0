"""Reading and publishing products: partitioned by season, in several formats, with a timestamp."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


#: Folders that a task writes side by side. Their row groups together are as large as the one of a single writer by default.
FOLDERS = 32
_WRITERS, _ROW_GROUP = "spark.sql.maxConcurrentOutputFileWriters", "parquet.block.size"


@contextmanager
def folders_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes by folders inside it don't sort their rows by folder first, which holds or spills all rows of a task: a
    file of each folder is open instead, with a smaller row group. A task with more folders than ``FOLDERS``
    sorts the rows of the further ones. A session that sets the number of files itself keeps it; 0 sorts them all."""
    if spark.conf.get(_WRITERS, None) is not None:
        yield
        return
    before = spark.conf.get(_ROW_GROUP, None)
    spark.conf.set(_WRITERS, str(FOLDERS))
    spark.conf.set(_ROW_GROUP, str(int(before or 128 * 2**20) // FOLDERS))
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS)
        if before is None:
            spark.conf.unset(_ROW_GROUP)
        else:
            spark.conf.set(_ROW_GROUP, before)


def read_archive(spark: SparkSession, path: str) -> DataFrame | None:
    """The product at the path, or None where none has been published."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def publish(df: DataFrame, path: str, formats=("parquet",), partition_by=("season",), mode: str = "overwrite") -> dict:
    """Writes ``<path>/<format>`` split by the partition columns and ``<path>/timestamp``; returns
    the stamp. Only partitions present in ``df`` are replaced with mode ``partitions``."""
    for fmt in formats:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        if fmt == "csv":
            writer = writer.option("header", True)
        if mode == "partitions":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite" if mode == "partitions" else mode).format(fmt).save(f"{path}/{fmt}")
    stamp = {"last_updated": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")}
    df.sparkSession.createDataFrame([(json.dumps(stamp),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/timestamp")
    return stamp


def publish_by_group(df: DataFrame, path: str, group_vars: list[str], formats=("parquet",)) -> dict:
    """One folder per combination of the group columns."""
    return publish(df, path, formats, tuple(group_vars))


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders of a product, wherever it is stored."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_state(spark: SparkSession, path: str) -> str:
    """Names, lengths and times of the files at the path, as one hash: equal where nothing was written since."""
    import hashlib

    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    held, files = [], system.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        held.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(held)).encode()).hexdigest()
