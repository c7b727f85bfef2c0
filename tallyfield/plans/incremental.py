"""Change detection, replacement of periods, and what to recompute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fingerprints import fingerprints

LEVELS = {"sum_level": ("week", "season"), "stat_level": ("player", "team"), "season_level": ("ALL", "REG", "POST", "REG+POST")}


def missing_keys(source: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of the source that the prior product lacks; null keys equal each other."""
    a, b = source.select(*keys).distinct(), prior.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    on = [a[k].eqNullSafe(b[f"_{k}"]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return a.join(b, cond, "left_anti")


def should_rebuild(source: DataFrame, prior: DataFrame | None, keys: list[str]) -> bool:
    """True if there is no prior product, it is empty, or it lacks a key of the source."""
    return prior is None or prior.isEmpty() or not missing_keys(source, prior, keys).isEmpty()


def replace_periods(prior: DataFrame, new: DataFrame, keys=("season",)) -> DataFrame:
    """The prior rows of periods that ``new`` doesn't have, and all of ``new``; missing columns are null."""
    kept = prior.join(F.broadcast(new.select(*keys).distinct()), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def last_periods(df: DataFrame, grid: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the weeks numbered first..last in the grid (season, week, week_seq)."""
    return df.join(F.broadcast(grid.where(F.col("week_seq").between(first, last)).select("season", "week")), ["season", "week"], "left_semi")


def stats_path(folder: str, sum_level: str, stat_level: str, season_level: str, ext: str = "parquet") -> str:
    """Canonical, lower-cased path of a stats product."""
    for name, value in (("sum_level", sum_level), ("stat_level", stat_level), ("season_level", season_level)):
        if value.lower() not in [v.lower() for v in LEVELS[name]]:
            raise ValueError(f"unknown {name} {value}")
    if ext.lower() not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown format {ext}")
    return f"{folder}/stats_{sum_level}_{stat_level}_{season_level}.{ext}".lower()


def season_types(season_level: str) -> list[str]:
    """The season types that a level stands for."""
    known = {"ALL": ["REG", "POST"], "REG+POST": ["REG", "POST"], "REG": ["REG"], "POST": ["POST"]}
    if season_level.upper() not in known:
        raise ValueError(f"unknown season level {season_level}")
    return known[season_level.upper()]


def cached_stats(spark, path: str, source: DataFrame, compute, counted: DataFrame | None = None, refresh: bool = False, recompute_all: bool = False) -> DataFrame:
    """The product kept at ``path`` by season, brought up to date: seasons whose source rows aren't what they were,
    by fingerprints kept beside the product, are computed from all their rows and replaced, others stay
    untouched; seasons that the source no longer has go. ``counted`` are the source's rows that tell whether a season
    is fresh (all by default). ``refresh`` computes the source's last season in any case, ``recompute_all``
    everything. The fingerprints are written last, so a run that ends early is done again."""
    from ..sources.archive import read_archive, remove_paths

    marks, old = f"{path}.marks", None
    new = fingerprints(source if counted is None else counted, ["season"]).collect()
    prior = None if recompute_all else read_archive(spark, path)
    if prior is not None and not prior.isEmpty():
        held = read_archive(spark, marks)
        old = None if held is None else held.collect()
    kept = {r["season"]: tuple(r) for r in old or []}
    stale = {r["season"] for r in new if kept.get(r["season"]) != tuple(r)}
    gone = set(kept) - {r["season"] for r in new}
    if refresh and new:
        stale.add(max((r["season"] for r in new if r["season"] is not None), default=None))
    if old is None or stale:
        rows = source if old is None else source.where(F.col("season").isin([s for s in stale if s is not None]) | F.lit(None in stale) & F.col("season").isNull())
        writer = compute(rows).write.option("partitionOverwriteMode", "static" if old is None else "dynamic")
        writer.mode("overwrite").partitionBy("season").parquet(path)
    if gone:
        remove_paths(spark, [f"{path}/season={'__HIVE_DEFAULT_PARTITION__' if s is None else s}" for s in gone])
    if old is None or stale or gone:
        spark.createDataFrame([tuple(r) for r in new], "season int, _rows long, _sum string, _folded long").coalesce(1).write.mode("overwrite").parquet(marks)
    return spark.read.parquet(path)
