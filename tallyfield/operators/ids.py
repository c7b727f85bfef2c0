"""Resolving the keys of games from whatever identifying columns a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .games import unpivot_sides

#: The key sets in order of preference, and which map each is looked up in.
KEY_SETS = [
    (("game_id", "home_team", "away_team"), "wide"), (("game_id", "home_team"), "wide"), (("game_id", "away_team"), "wide"),
    (("game_id", "team", "opponent"), "long"), (("game_id", "team"), "long"), (("game_id", "opponent"), "long"),
    (("season", "week", "home_team", "away_team"), "wide"), (("season", "week", "home_team"), "wide"), (("season", "week", "away_team"), "wide"),
    (("season", "week", "team", "opponent"), "long"), (("season", "week", "team"), "long"), (("season", "week", "opponent"), "long"),
]


def key_set(columns) -> tuple[tuple[str, ...], str]:
    """The first key set whose columns are all there."""
    for keys, kind in KEY_SETS:
        if set(keys) <= set(columns):
            return keys, kind
    raise ValueError("no set of columns identifies games")


def row_numbers(df: DataFrame, name: str) -> DataFrame:
    """The rows with their number, from 0, in the order that the table is read in. Two passes: one counts the rows of
    each partition, a number each for the driver; the other adds a partition's offset to the row's place in
    it. No row moves. The plan below has to give the same partitions again, as files and tables do."""
    place, inside = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    marked = df.withColumn("_m", F.monotonically_increasing_id())
    counts = {r["p"]: r["n"] for r in marked.groupBy(place.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    table = F.lit(offsets) if offsets else F.array(F.lit(0))
    return marked.withColumn(name, inside + F.get(table.cast("array<bigint>"), place.cast("int"))).drop("_m")


def add_game_ids(df: DataFrame, schedules: DataFrame, order_by: str | None = None, preserve_order: bool = False) -> DataFrame:
    """Inner join with the schedule on the first usable key set; the schedule's columns come first
    and win over equally named ones. ``order_by`` sorts by a row id of the input, ``preserve_order`` by the order
    of its rows, which are numbered for it; several games of a row come by id."""
    keys, kind = key_set(df.columns)
    order = [] if order_by is None else [order_by]
    if preserve_order:
        df, order = row_numbers(df, "_row"), ["_row", "game_id"]
    wide = schedules.select("game_id", "season", "week", "home_team", "away_team", "location")
    found = wide.drop("location") if kind == "wide" else unpivot_sides(wide).select("game_id", "season", "week", "team", "opponent", "location")
    out = found.join(df.drop(*[c for c in found.columns if c in df.columns and c not in keys]), list(keys))
    out = out.select(*found.columns, *[c for c in df.columns if c not in found.columns])
    out = out.orderBy(*order) if order else out
    return out.drop("_row") if preserve_order else out
