"""Aggregates of plays by team and game, or by team and week."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.exprs import masked_count, masked_mean, masked_sum, ratio
from .ids import add_game_ids

CLASSES = ["total", "pass", "rush", "penalty", "kick", "special"]
KEYS = ["game_id", "season", "week", "team", "home_team", "away_team"]


def _classes(scaled_wp: bool) -> tuple[dict, Column]:
    """The conditions of the six classes, and the value that is added up."""
    one = F.col("play") == 1
    masks = {
        "total": one | (F.col("play_type") == "field_goal"),
        "pass": one & (F.col("pass") == 1) & (F.col("penalty") == 0),
        "rush": one & (F.col("rush") == 1) & (F.col("penalty") == 0),
        "penalty": one & (F.col("penalty") == 1),
        "kick": F.col("play_type") == "field_goal",
        "special": (F.col("special") == 1) & (F.col("play_type") != "field_goal"),
    }
    half = F.lit(0.5) - F.col("vegas_wp")
    return masks, F.col("epa") * (1 - 4 * half * half) if scaled_wp else F.col("epa")


def _measures(side: str, scaled_wp: bool) -> list:
    """Count, sum and mean of expected points added of the six classes."""
    aggs, (masks, value) = [], _classes(scaled_wp)
    for name, mask in masks.items():
        p = f"{side[:3]}_{name}"
        aggs += [masked_count(mask).alias(f"{p}_plays"), masked_sum(mask, value).alias(f"{p}_epa_sum"), masked_mean(mask, value).alias(f"{p}_epa_mean")]
    return aggs


def _side_measures(side: str, where: Column) -> list:
    """``_measures`` from the sums of pairs of teams, of those of a condition."""
    aggs, total = [], lambda c: F.sum(F.when(where, F.col(c)))
    for name in CLASSES:
        p, s, n = f"{side[:3]}_{name}", total(f"_{name}_sum"), total(f"_{name}_n")
        aggs += [F.coalesce(total(f"_{name}_plays"), F.lit(0)).alias(f"{p}_plays"), F.coalesce(s, F.lit(0.0)).alias(f"{p}_epa_sum")]
        aggs.append(F.coalesce(F.when(n > 0, s / n), F.lit(0.0)).alias(f"{p}_epa_mean"))
    return aggs


def epa_ratings(plays: DataFrame, side: str, scaled_wp: bool = False) -> DataFrame:
    """Count, sum and mean of expected points added of six classes of plays, by team and game, in one
    aggregation; ``side`` is ``offense`` or ``defense``."""
    if side not in ("offense", "defense"):
        raise ValueError("side must be offense or defense")
    team = "posteam" if side == "offense" else "defteam"
    rows = plays.where(F.col("epa").isNotNull() & F.col("ep").isNotNull() & F.col(team).isNotNull())
    return rows.groupBy("game_id", "season", "week", F.col(team).alias("team"), "home_team", "away_team").agg(*_measures(side, scaled_wp))


def epa(plays: DataFrame, scaled_wp: bool = False, observation: Observation | None = None) -> DataFrame:
    """Offense of every team game, and its defense (null where it has none), in one pass: plays are added up once by game
    and pair of teams, a few rows a game, and these sums count for either side's team. Nothing is joined and plays are
    scanned once.

    With an ``observation`` the counts that ``warn_of_sides`` compares are taken along; no job is run for them.
    """
    masks, value = _classes(scaled_wp)
    sums = [x for c, m in masks.items() for x in (masked_count(m).alias(f"_{c}_plays"), F.sum(F.when(m, value)).alias(f"_{c}_sum"), F.count(F.when(m, value)).alias(f"_{c}_n"))]
    rows = plays.where(F.col("epa").isNotNull() & F.col("ep").isNotNull())
    pairs = rows.groupBy(*[k for k in KEYS if k != "team"], "posteam", "defteam").agg(F.count(F.lit(1)).alias("_n"), *sums)
    side = F.explode(F.array(F.struct(F.col("posteam").alias("team"), F.lit(0).alias("_side")), F.struct(F.col("defteam").alias("team"), F.lit(1).alias("_side"))))
    rows = pairs.withColumn("_s", side).select("*", "_s.team", "_s._side").where(F.col("team").isNotNull())
    own, other = (F.coalesce(F.sum(F.when(F.col("_side") == k, F.col("_n"))), F.lit(0)) for k in (0, 1))
    aggs = [*_side_measures("offense", F.col("_side") == 0), *_side_measures("defense", F.col("_side") == 1)]
    out = rows.groupBy(*KEYS).agg(own.alias("_off"), other.alias("_def"), *aggs)
    if observation is not None:
        has, had = F.col("_off") > 0, F.col("_def") > 0
        out = out.observe(observation, F.count_if(has).alias("offense"), F.count_if(had).alias("defense"), F.count_if(has & had).alias("both"))
    kept = [F.when(F.col("_def") > 0, F.col(c)).alias(c) if c.startswith("def_") else F.col(c) for c in out.columns if c not in ("_off", "_def")]
    return out.where("_off > 0").select(*kept)


def warn_of_sides(observation: Observation) -> dict[str, int]:
    """After an action on an observed ``epa``: its counts of team games with an offense, with a defense and with both, and a
    warning with them unless they are the same."""
    counts = observation.get
    if len(set(counts.values())) > 1:
        warnings.warn(f"EPA sides: {counts['offense']} team games with an offense, {counts['defense']} with a defense, {counts['both']} with both", stacklevel=2)
    return counts


def turnovers(long: DataFrame, plays: DataFrame, pairing: str = "game") -> DataFrame:
    """Turnovers lost, won and their difference, by played team game. ``pairing='game'`` takes as won
    what the opponent lost in the game; ``'global'`` reverses the list of all team games in order."""
    lost = plays.where(F.col("posteam").isNotNull()).groupBy("game_id", "season", "week", "posteam", "defteam").agg(
        F.coalesce(F.sum("interception"), F.lit(0)).alias("interception_lost"), F.coalesce(F.sum("fumble_lost"), F.lit(0)).alias("fumble_lost")
    )
    lost = lost.withColumn("turnover_lost", F.col("interception_lost") + F.col("fumble_lost"))
    names = ["interception", "fumble", "turnover"]
    if pairing == "game":
        other = lost.select("game_id", F.col("posteam").alias("defteam"), F.col("defteam").alias("posteam"), *[F.col(f"{n}_lost").alias(f"{n}_won") for n in names])
        both = lost.join(other, ["game_id", "posteam", "defteam"], "left")
    elif pairing == "global":
        # numbered inside each season; the seasons' counts, a row each, make the numbers dense
        order = ["week", "game_id", "posteam", "defteam"]
        held = lost.groupBy("season").agg(F.count(F.lit(1)).alias("_c"))
        seasons = Window.orderBy("season")
        held = held.select("season", (F.sum("_c").over(seasons) - F.col("_c")).alias("_o"), F.sum("_c").over(Window.partitionBy()).alias("_total"))
        numbered = lost.withColumn("_k", F.row_number().over(Window.partitionBy("season").orderBy(*order)))
        numbered = numbered.join(F.broadcast(held), "season").withColumn("_n", F.col("_o") + F.col("_k"))
        other = numbered.select((F.col("_total") + 1 - F.col("_n")).alias("_n"), *[F.col(f"{n}_lost").alias(f"{n}_won") for n in names])
        both = numbered.join(other, "_n", "left")
    else:
        raise ValueError("pairing must be game or global")
    both = both.withColumn("turnover_diff", F.col("turnover_won") - F.col("turnover_lost"))
    columns = ["turnover_diff", "turnover_won", "turnover_lost", "interception_won", "interception_lost", "fumble_won", "fumble_lost"]
    ids = long.where(F.col("result").isNotNull()).select("game_id", "season", "week", "team", "opponent")
    return ids.join(both.select("game_id", F.col("posteam").alias("team"), *columns), ["game_id", "team"], "left").select("game_id", "season", "week", "team", "opponent", *columns)


def redzone(long: DataFrame, plays: DataFrame, pairing: str = "game") -> DataFrame:
    """Red-zone rates of offense and defense, by played team game. ``pairing='first'`` takes the
    defense's rates from the first game, by id, in which the team was the opponent."""
    drives = plays.where(F.col("posteam").isNotNull()).select("game_id", "season", "week", "posteam", "home_team", "away_team", "fixed_drive", "fixed_drive_result", "drive_inside20").distinct()
    inside = F.col("drive_inside20") == 1
    off = drives.groupBy("game_id", "season", "week", "posteam", "home_team", "away_team").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(inside, 1)).alias("app"), F.count(F.when(inside & (F.col("fixed_drive_result") == "Touchdown"), 1)).alias("td")
    )
    opponent = F.when(F.col("posteam") == F.col("home_team"), F.col("away_team")).otherwise(F.col("home_team"))
    off = off.select("game_id", "season", "week", F.col("posteam").alias("team"), opponent.alias("opponent"), ratio(F.col("app"), F.col("n")).alias("app_perc"), ratio(F.col("td"), F.col("app")).alias("eff"))
    rates = ["app_perc", "eff"]
    own = off.select("game_id", "season", "week", "team", "opponent", *[F.col(r).alias(f"off_red_zone_{r}") for r in rates])
    if pairing == "game":
        faced = off.select("game_id", F.col("opponent").alias("team"), *[F.col(r).alias(f"def_red_zone_{r}") for r in rates])
        both = own.join(faced, ["game_id", "team"], "left")
    elif pairing == "first":
        first = off.groupBy(F.col("opponent").alias("team")).agg(F.min_by(F.struct(*rates), F.struct("game_id", "team")).alias("f"))
        both = own.join(first, "team", "left").select(*own.columns, *[F.col(f"f.{r}").alias(f"def_red_zone_{r}") for r in rates])
    else:
        raise ValueError("pairing must be game or first")
    ids = long.where(F.col("result").isNotNull()).select("game_id", "season", "week", "team", "opponent")
    out = ids.join(both, ids.columns, "left")
    return out.fillna(0, [c for c in out.columns if "red_zone" in c])


def series(plays: DataFrame, weekly: bool = True) -> DataFrame:
    """Series (sets of downs) by team and week, or team and season: how many, the share that succeeds,
    and the share of plays by down in succeeding ones; for the offense and mirrored for the defense."""
    keys = ["season", "week"] if weekly else ["season"]

    def side(team: str, p: str) -> DataFrame:
        sets = plays.where(F.col(team).isNotNull()).groupBy(*keys, F.col(team).alias("team"), "game_id", "series").agg(
            F.max("series_success").alias("ok"), F.max("down").alias("last")
        )
        return sets.groupBy(*keys, "team").agg(
            F.count(F.lit(1)).alias(f"{p}_n"),
            (F.sum("ok") / F.count(F.lit(1))).alias(f"{p}_scr"),
            *[ratio(F.count(F.when((F.col("last") == d) & (F.col("ok") == 1), 1)), F.count(F.when(F.col("last") == d, 1))).alias(f"{p}_scr_{d}") for d in (1, 2, 3, 4)],
        )

    return side("posteam", "off").join(side("defteam", "def"), [*keys, "team"], "left")


def series_with_ids(plays: DataFrame, schedules: DataFrame) -> DataFrame:
    return add_game_ids(series(plays), schedules)
