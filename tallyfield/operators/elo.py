"""Sequential skill ratings with regression to the mean between seasons and resumable state."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = "game_id string, season int, week int, gameday date, home_team string, away_team string, home_score double, away_score double, location string"
OUT = COLUMNS + ", home_elo_pre double, away_elo_pre double, home_elo_post double, away_elo_post double"


class Ratings:
    """The state between games: each team's rating and the season of the last game."""

    def __init__(self, initial: float = 1500.0, k: float = 20.0, home_advantage: float = 65.0, d: float = 400.0, margin: bool = False, season_factor: float = 0.6):
        self.initial, self.k, self.hfa, self.d, self.margin, self.factor = initial, k, home_advantage, d, margin, season_factor
        self.held: dict[str, float] = {}
        self.season: int | None = None
        self.first = True

    def mean(self) -> float:
        return math.fsum(self.held.values()) / len(self.held)

    def open_season(self, season: int) -> None:
        if self.season is not None and season != self.season:
            m = self.mean()
            self.held = {t: r * self.factor + m * (1 - self.factor) for t, r in self.held.items()}
            self.first = False
        elif self.season is None:
            self.first = not self.held
        self.season = season

    def of(self, team: str) -> float:
        """A team not seen before starts at the initial rating in the first season, at the mean later."""
        if team not in self.held:
            self.held[team] = self.initial if self.first else self.mean()
        return self.held[team]

    def play(self, season, home, away, hs, as_, location) -> tuple[float, float, float, float]:
        self.open_season(season)
        h, a = self.of(home), self.of(away)
        edge = self.hfa if location == "Home" else 0.0
        expected = 1 / (1 + 10 ** ((a - (h + edge)) / self.d))
        s = 1.0 if hs > as_ else 0.0 if hs < as_ else 0.5
        mult = 1.0
        if self.margin and hs != as_:
            mult = math.log(abs(hs - as_) + 1) * 2.2 / (0.001 * abs(h - a + edge) + 2.2)
        self.held[home] = h + self.k * mult * (s - expected)
        self.held[away] = a + self.k * mult * ((1 - s) - (1 - expected))
        return h, a, self.held[home], self.held[away]


def latest_ratings(history: DataFrame) -> DataFrame:
    """(team, season, elo): each team's rating after its last game."""
    sides = history.select("season", "week", "game_id", F.explode(F.array(
        F.struct(F.col("home_team").alias("team"), F.col("home_elo_post").alias("elo")), F.struct(F.col("away_team").alias("team"), F.col("away_elo_post").alias("elo"))
    )).alias("s"))
    return sides.groupBy("s.team").agg(F.max_by("s.elo", F.struct("season", "week", "game_id")).alias("elo"), F.max("season").alias("season"))


def played_games(games: DataFrame, league=None) -> DataFrame:
    """The played games with the columns that ratings need, and their league where one is given."""
    played = games.where(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    columns = ["game_id", "season", "week", F.to_date("gameday").alias("gameday"), "home_team", "away_team", "home_score", "away_score", "location"]
    return played.select(*columns) if league is None else played.select(*columns, league.alias("league"))


def elo_history(games: DataFrame, prior: DataFrame | None = None, **params) -> DataFrame:
    """Ratings before and after every played game, in the order of season, week, day and id.

    The fold is serial by nature: games stream through one task in order, with one number a team as
    state. With ``prior``, an earlier history, only games after its last week are rated, from the
    ratings it ends with, and appended; none means the history as it is.
    """
    played = played_games(games)
    seed, season = {}, None
    if prior is not None:
        last = prior.agg(F.max(F.struct("season", "week")).alias("m")).first()["m"]
        if last is not None:
            played = played.where(F.struct("season", "week") > F.struct(F.lit(last["season"]), F.lit(last["week"])))
            seed = {r["team"]: r["elo"] for r in latest_ratings(prior).collect()}
            season = last["season"]

    def run(frames):
        state = Ratings(**params)
        state.held, state.season, state.first = dict(seed), season, not seed
        for f in frames:
            rows = [state.play(r.season, r.home_team, r.away_team, r.home_score, r.away_score, r.location) for r in f.itertuples(index=False)]
            yield pd.concat([f.reset_index(drop=True), pd.DataFrame(rows, columns=["home_elo_pre", "away_elo_pre", "home_elo_post", "away_elo_post"])], axis=1)

    new = played.repartition(1).sortWithinPartitions("season", "week", "gameday", "game_id").mapInPandas(run, OUT)
    return new if prior is None else prior.select(*new.columns).unionByName(new)
