"""Queries over products that are kept current: each goes through several updates and gives what the product then holds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import games, plays, stats
from ..session import shared_folder
from ..sources import league
from ..streaming.ratings import follow_elo
from ..streaming.replace import follow_series
from . import slices

#: The updates, by season: a first build, a season's worth, and the rest.
STEPS = ["season <= 1997", "season = 1998", "season > 1998"]


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def elo_stream(x) -> DataFrame:
    """Ratings from a stream of schedules that is stopped and goes on between the steps."""
    folder, rows = shared_folder(x.spark, "elo"), x.written("schedules")
    rows = rows.select("game_id", "season", "week", "gameday", "home_team", "away_team", "home_score", "away_score", "location")
    for step in STEPS:
        rows.where(step).write.mode("append").parquet(f"{folder}/games")
        follow_elo(x.spark, f"{folder}/games", _schema(rows), f"{folder}/rated", f"{folder}/mark", home_advantage=0.0).awaitTermination()
    return x.spark.read.parquet(f"{folder}/rated")


def srs_slices(x, resets=(True, 10, 20), max_iter: int = 100) -> DataFrame:
    """Ratings of all slices, of which each step computes those that new weeks reach."""
    path, rows = shared_folder(x.spark, "srs"), x.written("games")
    for season in (1997, 1998, 9999):
        slices.refresh_slices(x.spark, path, rows.where(F.col("season") <= season), resets, max_iter=max_iter)
    return x.spark.read.parquet(path)


def series_kept(x) -> DataFrame:
    """Weekly series that follow plays as their seasons arrive."""
    folder, rows = shared_folder(x.spark, "series"), x.written("plays")
    rows = rows.select("game_id", "week", "posteam", "defteam", "series", "series_success", "down", "season")
    for step in STEPS:
        rows.where(step).write.mode("append").partitionBy("season").parquet(f"{folder}/plays")
        follow_series(x.spark, f"{folder}/plays", _schema(rows), f"{folder}/series", f"{folder}/mark").awaitTermination()
    return x.spark.read.parquet(f"{folder}/series")


def stats_kept(x) -> DataFrame:
    """A season's team stats after weeks of known teams were added to known seasons."""
    folder, rows, played = shared_folder(x.spark, "stats"), x.written("team_stats"), x.written("games")
    for step in ("season < 1999 or week <= 4", "true"):
        out = stats.level_stats(x.spark, folder, rows.where(step), played, league.STATS, "season", "team", "REG")
    return out


def epa_bucketed(x) -> DataFrame:
    """EPA of two seasons from a table in folders by season and buckets by game: no exchange, no other season read."""
    name = f"plays_{uuid.uuid4().hex}"
    league.write_plays(x.plays, name, path=shared_folder(x.spark, "plays"))
    return plays.epa(league.load_plays(x.spark, name, [1996, 1999]))


def player_kicking(x) -> DataFrame:
    """Players of one kind in some seasons, with their games."""
    some = league.player_weeks(x.spark, x.sf_dir, seasons=[1996, 1997, 1999], stat="kicking")
    return games.players_with_games(some, x.long)
