"""Counting stats by level: of weeks or seasons, of teams or players, of the season types wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.incremental import cached_stats, season_types, stats_path
from .ids import add_game_ids

ENTITIES = {"team": "team", "player": "player_id"}


def of_types(rows: DataFrame, games: DataFrame, season_level: str) -> DataFrame:
    """The rows of weeks of the season types that the level stands for, with the week's type."""
    weeks = games.select("season", "week", "season_type").distinct()
    return rows.drop("season_type").join(F.broadcast(weeks.where(F.col("season_type").isin(season_types(season_level)))), ["season", "week"])


def stats_by_level(rows: DataFrame, games: DataFrame, measures: list[str], sum_level: str, stat_level: str, season_level: str) -> DataFrame:
    """Sums of the measures and the weeks they come from, by season, or by season and week, and team or player.
    A week has its own season type, a season the level's name; nulls count as 0."""
    stats_path("", sum_level, stat_level, season_level)  # raises for an unknown level
    typed = of_types(rows, games, season_level)
    if sum_level.lower() == "season":
        typed = typed.withColumn("season_type", F.lit(season_level.upper()))
    keys = ["season", *(["week"] if sum_level.lower() == "week" else []), ENTITIES[stat_level.lower()], "season_type"]
    return typed.groupBy(*keys).agg(F.count_distinct("week").alias("games"), *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in measures])


def level_stats(
    spark, folder: str, rows: DataFrame, games: DataFrame, measures: list[str], sum_level: str, stat_level: str, season_level: str, schedules: DataFrame | None = None, **rebuild
) -> DataFrame:
    """The product of a level kept in ``folder``: seasons whose rows changed, by content, are recomputed and replaced,
    at season level too (``refresh`` and ``recompute_all`` as in ``cached_stats``). Rows of weeks without a
    played game don't make a season stale. With ``schedules``, weekly rows of teams carry the ids of their games."""
    source = of_types(rows, games, season_level).select("season", "week", ENTITIES[stat_level.lower()], "season_type", *measures)
    played = games if "result" not in games.columns else games.where(F.col("result").isNotNull())
    counted = source.join(F.broadcast(played.select("season", "week").distinct()), ["season", "week"], "left_semi")

    def compute(r: DataFrame) -> DataFrame:
        out = stats_by_level(r, games, measures, sum_level, stat_level, season_level)
        return out if schedules is None or (sum_level.lower(), stat_level.lower()) != ("week", "team") else add_game_ids(out, schedules)

    # the name is canonical, the folder stays as it is written
    path = folder + stats_path("", sum_level, stat_level, season_level)
    return cached_stats(spark, path, source, compute, counted, **rebuild)
