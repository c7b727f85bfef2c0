"""Elo ratings from a stream of games, with the ratings as its state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.elo import OUT, Ratings, played_games
from ..session import ship_package

RATED = ["home_elo_pre", "away_elo_pre", "home_elo_post", "away_elo_post"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class EloProcessor(StatefulProcessor):
    """A league's state: a rating for each team, and the last week rated. A batch's games are rated in order; games up
    to the last week are known already and change nothing."""

    def __init__(self, params: dict):
        self.params = params

    def init(self, handle) -> None:
        self.ratings = handle.getMapState("ratings", "team string", "elo double")
        self.last = handle.getValueState("last", "season int, week int, first boolean")

    def handleInputRows(self, key, rows, timerValues):
        games = pd.concat(list(rows), ignore_index=True)
        state = Ratings(**self.params)
        if self.last.exists():
            season, week, state.first = self.last.get()
            state.season = season
            state.held = {k[0]: v[0] for k, v in self.ratings.iterator()}
            games = games[(games["season"] > season) | (games["season"] == season) & (games["week"] > week)]
        # every week of a batch is rated whole: a game twice in it counts once
        games = games.sort_values(["season", "week", "gameday", "game_id"]).drop_duplicates("game_id").reset_index(drop=True)
        if not len(games):
            return
        found = [state.play(g.season, g.home_team, g.away_team, g.home_score, g.away_score, g.location) for g in games.itertuples(index=False)]
        for team, elo in state.held.items():
            self.ratings.updateValue((team,), (float(elo),))
        last = games.iloc[-1]
        self.last.update((int(last["season"]), int(last["week"]), bool(state.first)))
        yield pd.concat([games.drop(columns=["league"]), pd.DataFrame(found, columns=RATED)], axis=1)

    def close(self) -> None:
        pass


def rated_stream(games: DataFrame, league: str | None = None, **params) -> DataFrame:
    """The rated games of a stream of schedules, as ``elo_history`` rates them. ``league`` is a column that keeps leagues
    apart, each with its own state; a league is one ordered fold and so one task."""
    rows = played_games(games, F.lit("league") if league is None else F.col(league).cast("string"))
    return rows.groupBy("league").transformWithStateInPandas(EloProcessor(params), OUT, "Append", "None")


def follow_elo(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, league: str | None = None, **params) -> StreamingQuery:
    """Rates what is new under ``source``, appends it to ``target`` and stops. The state is in the checkpoint, so the next
    call, after a restart too, goes on from the last week. Weeks have to arrive in order, each whole; games of a
    week that was rated before, and files that come twice, change nothing."""
    ship_package(spark)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        stream = rated_stream(spark.readStream.schema(schema).parquet(source), league, **params)
        return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
