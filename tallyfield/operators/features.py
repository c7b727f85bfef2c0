"""Modelling tables: lagged features by team game, and the wide form by game."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDS = ["game_id", "season", "week", "team", "opponent"]


def lagged(df: DataFrame, columns: list[str], window: int = 5, span: int = 5) -> DataFrame:
    """For each column the mean of all earlier games of the team, of its last ``window`` games, and the
    exponentially weighted mean of the last ``10 * span`` (at span 5, earlier games have a weight of 1.6e-9 together), always
    without the game itself; nulls are passed over. One group holds the games of one team and serves all columns."""
    if not columns:
        return df
    alpha, names = 2 / (span + 1), [f"{c}_{kind}_lag" for c in columns for kind in ("cum", "roll", "ewma")]

    def past(games: pa.Table) -> pa.Table:
        order = [(k, "ascending") for k in ("season", "week", "game_id")]
        games = games.take(pc.sort_indices(games, sort_keys=order, null_placement="at_start"))
        values = np.column_stack([games[c].cast(pa.float64(), safe=False).to_numpy() for c in columns])
        seen = ~np.isnan(values)
        # row i of the cumulative tables has the games before game i
        sums, counts = (np.vstack([np.zeros((1, len(columns))), np.cumsum(x, axis=0)[:-1]]) for x in (np.where(seen, values, 0.0), seen))
        total, number, weighted = np.zeros_like(values), np.zeros_like(values), np.full_like(values, np.nan)
        for back in range(min(10 * span, len(values) - 1), 0, -1):
            x, to = values[:-back], weighted[back:]
            to[:] = np.where(np.isnan(x), to, np.where(np.isnan(to), x, to * (1 - alpha) + x * alpha))
        for back in range(min(window, len(values) - 1), 0, -1):
            total[back:] += np.where(seen, values, 0.0)[:-back]
            number[back:] += seen[:-back]
        with np.errstate(divide="ignore", invalid="ignore"):
            kinds = (sums / counts, total / number, weighted)
        for i, name in enumerate(names):
            games = games.append_column(name, pa.array(kinds[i % 3][:, i // 3], from_pandas=True))
        return games

    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    return df.groupBy("team").applyInArrow(past, schema)


def net(df: DataFrame, columns: list[str]) -> DataFrame:
    """``net_x`` = the team's ``off_x`` less the opponent's ``def_x`` in the game, of lagged features; null where the
    opponent has no row. A game's two sides are the least and the greatest by team, so the plan below runs once."""
    side, game = F.struct("team", *[F.col(f"def_{c}") for c in columns]), Window.partitionBy("game_id")
    sides = df.withColumns({"_least": F.min(side).over(game), "_greatest": F.max(side).over(game)})
    other = F.when(F.col("_least.team") == F.col("opponent"), F.col("_least")).when(F.col("_greatest.team") == F.col("opponent"), F.col("_greatest"))
    return sides.withColumn("_other", other).select(*df.columns, *[(F.col(f"off_{c}") - F.col(f"_other.def_{c}")).alias(f"net_{c}") for c in columns])


def model_long(long: DataFrame, elo: DataFrame, srs: DataFrame, epa: DataFrame, scores: DataFrame, series: DataFrame, turnover: DataFrame, redzone: DataFrame, window: int = 5, span: int = 5) -> DataFrame:
    """Features of every rated team game: ratings before it, and lagged play, score, series, turnover and
    red-zone features. One group a team serves all of them."""
    sides = elo.select("game_id", F.explode(F.array(
        F.struct(F.col("home_team").alias("team"), F.col("home_elo_pre").alias("team_elo_pre"), F.col("away_elo_pre").alias("opponent_elo_pre")),
        F.struct(F.col("away_team").alias("team"), F.col("away_elo_pre").alias("team_elo_pre"), F.col("home_elo_pre").alias("opponent_elo_pre")),
    )).alias("s")).select("game_id", "s.*")
    rates = [c for c in srs.columns if c not in ("season", "week", "team")]
    order = Window.partitionBy("team").orderBy("season", "week")
    before = srs.select("season", "week", "team", *[F.lag(c).over(order).alias(f"srs_{c}_lag") for c in rates])
    base = long.select(*IDS, "week_seq", "location", "result").join(sides, ["game_id", "team"], "left").join(before, ["season", "week", "team"], "left")
    facts = []
    for df, keys in ((epa, ["game_id", "team"]), (scores, ["game_id", "team"]), (series, ["season", "week", "team"]), (turnover, ["game_id", "team"]), (redzone, ["game_id", "team"])):
        values = [c for c in df.columns if c not in {*IDS, "home_team", "away_team", "location"}]
        facts += values
        base = base.join(df.select(*keys, *values), keys, "left")
    out = lagged(base, facts, window, span).drop(*facts)
    pairs = [c[4:] for c in out.columns if c.startswith("off_") and f"def_{c[4:]}" in out.columns]
    return net(out, pairs).where(F.col("team_elo_pre").isNotNull())


def model_wide(features: DataFrame, games: DataFrame) -> DataFrame:
    """Games with every feature of both sides as ``home_x`` and ``away_x``."""
    names = games.select("game_id", F.col("home_team").alias("_home"))
    values = [c for c in features.columns if c not in {*IDS, "week_seq", "location", "result"}]
    sided = features.join(names, "game_id").withColumn("side", F.when(F.col("team") == F.col("_home"), "home").otherwise("away"))
    wide = sided.groupBy("game_id").agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for s in ("home", "away") for c in values])
    return games.join(wide, "game_id", "left")
