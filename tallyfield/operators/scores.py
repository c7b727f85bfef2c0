"""How a team's points of a game are made up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDS = ["game_id", "season", "week", "team"]

#: Corrections of known data errors, by (season, week, team).
CORRECTIONS = [
    (2011, 13, "DET", {"rushing_tds": 1, "pat_att": 2, "pat_made": 2}),
    (2011, 13, "NO", {"rushing_tds": 1, "passing_tds": 3, "pat_att": 4, "pat_made": 4}),
    (2019, 15, "ARI", {"rushing_tds": 4, "td_special": 0}),
    (2019, 15, "CLE", {"passing_tds": 2, "pat_att": 3, "pat_made": 3}),
]


def stat_columns(stats: DataFrame) -> DataFrame:
    return stats.selectExpr(
        "season", "week", "team", "passing_tds", "rushing_tds", "special_teams_tds as td_special", "def_tds", "fumble_recovery_tds",
        "passing_2pt_conversions", "rushing_2pt_conversions", "pat_att", "pat_made", "fg_att", "fg_made", "def_safeties as safeties_def",
    )


def corrected(df: DataFrame, corrections=tuple(CORRECTIONS)) -> DataFrame:
    """The table with single cells replaced, by three-column key."""
    out = {}
    for season, week, team, cells in corrections:
        here = (F.col("season") == season) & (F.col("week") == week) & (F.col("team") == team)
        for c, value in cells.items():
            out[c] = F.when(here, F.lit(value)).otherwise(out.get(c, F.col(c)))
    return df.withColumns({c: v.cast(df.schema[c].dataType) for c, v in out.items()})


def two_point(plays: DataFrame) -> DataFrame:
    return plays.where(F.col("posteam").isNotNull()).groupBy("season", "week", F.col("posteam").alias("team")).agg(
        F.coalesce(F.sum("two_point_attempt"), F.lit(0)).alias("two_pt_att"),
        F.count(F.when(F.col("two_point_conv_result") == "success", 1)).alias("two_pt_made"),
        F.coalesce(F.sum("defensive_two_point_conv"), F.lit(0)).alias("two_pt_def"),
    )


def scores(long: DataFrame, stats: DataFrame, plays: DataFrame, corrections=tuple(CORRECTIONS)) -> DataFrame:
    """Points by kind for every played team game; a defense's two-point returns are what is
    recorded against the opponent's offense."""
    base = corrected(stat_columns(stats), corrections)
    base = base.fillna(0, [c for c in base.columns if c not in ("season", "week", "team")])
    base = base.withColumns({"td_off": F.col("passing_tds") + F.col("rushing_tds"), "td_def": F.col("def_tds") + F.col("fumble_recovery_tds")})
    base = base.withColumn("td_total", F.col("td_off") + F.col("td_special") + F.col("td_def"))
    two = two_point(plays)
    ids = long.where(F.col("result").isNotNull()).select(*IDS, "opponent")
    faced = two.select("season", "week", F.col("team").alias("opponent"), "two_pt_def")
    keys = ["season", "week", "team"]
    out = ids.join(base, keys, "left").join(two.drop("two_pt_def"), keys, "left").join(faced, ["season", "week", "opponent"], "left")
    out = out.select(*IDS, *[c for c in base.columns if c not in keys], "two_pt_att", "two_pt_made", "two_pt_def")
    out = out.fillna(0, [c for c in out.columns if c not in IDS])
    out = out.withColumns({
        "points8": F.col("two_pt_made"), "points7": F.col("pat_made"), "points6": F.col("td_total") - F.col("two_pt_made") - F.col("pat_made"),
        "points3": F.col("fg_made"), "points2": F.col("safeties_def") + F.col("two_pt_def"),
    })
    return out.withColumn("points_total", F.expr("points8 * 8 + points7 * 7 + points6 * 6 + points3 * 3 + points2 * 2"))
