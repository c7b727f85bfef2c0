"""Keeping a product current from a stream of its source's files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.plays import series
from ..sources.archive import read_archive


def seasons_of(spark: SparkSession, source: str, schema: str, seasons: list, season: str = "season") -> DataFrame:
    """The source's rows of some seasons. They are literals, so of a source in folders by season only these are read."""
    return spark.read.schema(schema).parquet(source).where(F.col(season).isin(seasons))


def follow(spark: SparkSession, source: str, schema: str, compute, target: str, checkpoint: str, season: str = "season") -> StreamingQuery:
    """Runs through what is new under ``source``, which lies in folders by season, and stops.

    The seasons of a batch's rows (few: they are held on the driver) are computed from all their rows and replace the
    product's folders; no other season is read or written. ``<target>.applied`` logs each batch
    with its seasons once it is done, and a batch that is in the log is not applied again; one that was
    interrupted is, with the same result.
    """
    log = f"{target}.applied"

    def replace(batch: DataFrame, number: int) -> None:
        done = read_archive(spark, log)
        if done is not None and not done.where(F.col("batch") == number).isEmpty():
            return
        touched = sorted(r[0] for r in batch.select(season).distinct().collect() if r[0] is not None)
        if touched:
            rows = compute(seasons_of(spark, source, schema, touched, season))
            rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(season).parquet(target)
        row = (number, touched, datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC"))
        spark.createDataFrame([row], "batch long, seasons array<int>, applied string").coalesce(1).write.mode("append").parquet(log)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def follow_series(spark: SparkSession, plays: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Weekly series kept current from plays in folders by season: a season with new plays is dropped and computed again."""
    return follow(spark, plays, schema, series, target, checkpoint)
