"""Games: cleaning and enrichment, the long form by team, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import implied_probability, lag_or_zero, recoded, require_columns, running_sum, time_of_day, tri_state

DROPPED = ["old_game_id", "gsis", "nfl_detail_id", "pfr", "pff", "espn", "ftn", "away_qb_id", "home_qb_id", "stadium_id"]
ODDS = {"home_spread_odds": "home_spread_prob", "away_spread_odds": "away_spread_prob", "under_odds": "under_prob", "over_odds": "over_prob", "home_moneyline": "home_moneyline_prob", "away_moneyline": "away_moneyline_prob"}


def add_week_seq(df: DataFrame) -> DataFrame:
    """Adds ``week_seq`` after ``week``: the dense number of (season, week). Only the grid of
    distinct weeks, a few rows a year, is numbered in one task and sent to all."""
    grid = df.select("season", "week").distinct()
    grid = grid.withColumn("week_seq", F.row_number().over(Window.orderBy("season", "week")))
    at = df.columns.index("week") + 1
    return df.join(F.broadcast(grid), ["season", "week"], "left").select(*df.columns[:at], "week_seq", *df.columns[at:])


def _placed(columns: list[str], new: dict[str, str]) -> list[str]:
    """The columns with each new one behind the one it belongs to."""
    return [c for old in columns for c in [old, *[n for n, after in new.items() if after == old]]]


def clean_games(schedules: DataFrame, first_season: int | None = None, team_codes: dict[str, str] | None = None) -> DataFrame:
    """Cleaned and enriched games; ``first_season`` is a lower bound only."""
    df = schedules if first_season is None else schedules.where(F.col("season") >= first_season)
    codes = team_codes or {}
    df = df.withColumns({c: recoded(F.col(c), codes) for c in ("home_team", "away_team")})
    new = {"season_type": "game_type", **{p: o for o, p in ODDS.items()}, "spreadCover": "spread_line", "totalCover": "total_line", "winner": "result", "time_of_day": "gametime"}
    order = _placed(df.columns, new)
    df = df.withColumns({
        "season_type": F.when(F.col("game_type") == "REG", "REG").when(F.col("game_type").isNotNull(), "POST"),
        **{p: implied_probability(F.col(o)) for o, p in ODDS.items()},
        "spreadCover": tri_state(F.col("result"), F.col("spread_line")),
        "totalCover": tri_state(F.col("total"), F.col("total_line")),
        "winner": F.when(F.col("result") > 0, F.col("home_team")).when(F.col("result") < 0, F.col("away_team")),
        "time_of_day": time_of_day(F.col("gametime")),
    })
    return add_week_seq(df.select(*order)).drop(*DROPPED)


def unpivot_sides(df: DataFrame, invert=("result", "spread_line")) -> DataFrame:
    """Two rows a game, from one scan: ``home_x``/``away_x`` become ``team_x``/``opponent_x``
    (``team``/``opponent`` for the names), the inverted columns change sign for the away side."""
    paired = [c[5:] for c in df.columns if c.startswith("home_") and f"away_{c[5:]}" in df.columns]
    sided = {f"{s}_{c}" for c in paired for s in ("home", "away")}
    plain = [c for c in df.columns if c not in sided and c != "location"]

    def side(own: str, other: str, sign: int):
        names = [F.col(f"{s}_{c}").alias(t if c == "team" else f"{t}_{c}") for c in paired for s, t in ((own, "team"), (other, "opponent"))]
        kept = [(F.col(c) * sign).alias(c) if c in invert else F.col(c) for c in plain]
        place = F.when(F.lower("location") == "neutral", "neutral").otherwise(own).alias("location")
        return F.struct(*kept, place, *names, F.lit(0 if own == "home" else 1).alias("side"))

    return df.select(F.explode(F.array(side("home", "away", 1), side("away", "home", -1))).alias("s")).select("s.*")


def games_long(games: DataFrame) -> DataFrame:
    """Team rows with running records: wins, losses and ties before the game, points up to it.
    After an unplayed game the running values of the season are null, and a lag of null is 0."""
    df = unpivot_sides(games)
    w = Window.partitionBy("season", "team").orderBy("week", F.to_date("gameday"), "game_id")
    df = df.withColumn("winner", F.when(F.col("team") == F.col("winner"), True).when(F.col("opponent") == F.col("winner"), False))
    df = df.withColumns({
        "team_GP": F.row_number().over(w),
        "_W": running_sum((F.col("result") > 0).cast("long"), w),
        "_L": running_sum((F.col("result") < 0).cast("long"), w),
        "team_PF": running_sum(F.col("team_score"), w),
        "team_PA": running_sum(F.col("opponent_score"), w),
    })
    df = df.withColumn("_T", F.col("team_GP") - F.col("_W") - F.col("_L"))
    df = df.withColumns({
        "team_W": lag_or_zero(F.col("_W"), w), "team_L": lag_or_zero(F.col("_L"), w), "team_T": lag_or_zero(F.col("_T"), w),
        "team_PFG": F.col("team_PF") / F.col("team_GP"), "team_PAG": F.col("team_PA") / F.col("team_GP"),
        "locationID": F.col("side") + 1,
    })
    kept = [c for c in df.columns if not c.startswith("_") and c not in ("side", "locationID")]
    return df.select(*_placed(kept, {"locationID": "location"}))


def pair_to_wide(df: DataFrame, game_id: str = "game_id", location: str = "location", remove_opponent: bool = True, order_by=None, check: bool = True) -> DataFrame:
    """One row a game from its two team rows, values as ``home_x``/``away_x``. Of two neutral rows the
    first (by ``order_by``, else by team) is the home side. Every value column carries ``{"by": game_id, "side": ...}`` as metadata. ``check`` raises, after a job, unless every
    game has exactly two rows with known locations."""
    require_columns(df, [game_id, location])
    place = F.lower(F.col(location).cast("string"))
    if check:
        bad = df.groupBy(game_id).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~place.isin("home", "away", "neutral") | place.isNull(), 1)).alias("odd")).where("n <> 2 or odd > 0")
        if not bad.isEmpty():
            raise ValueError(f"each {game_id} needs exactly two rows located home, away or neutral")
    values = [c for c in df.columns if c not in (game_id, location)]
    w = Window.partitionBy(game_id).orderBy(*(order_by or [c for c in values if c == "team"] or values))
    rows = df.withColumn("_p", place).withColumn("_n", F.row_number().over(w))
    side = F.when(F.col("_p") == "neutral", F.when(F.col("_n") == 1, "home").otherwise("away")).otherwise(F.col("_p"))
    rows = rows.withColumn("_s", side)
    kept = [c for c in values if not (remove_opponent and c == "opponent")]
    return rows.groupBy(game_id).agg(*[F.max(F.when(F.col("_s") == s, F.col(c))).alias(f"{s}_{c}", metadata={"by": game_id, "side": s}) for s in ("home", "away") for c in kept])


def players_with_games(stats: DataFrame, long: DataFrame) -> DataFrame:
    """Player weeks with the game of (season, week, opponent), the game id first."""
    games = long.select("season", "week", F.col("opponent").alias("opponent_team"), "game_id")
    return stats.join(games, ["season", "week", "opponent_team"], "left").select("game_id", *stats.columns)
