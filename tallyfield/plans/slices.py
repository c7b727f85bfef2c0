"""Keeping the ratings of all weekly slices current: new, late and changed weeks recompute the slices they reach."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.standings import reset_mode, srs_data
from ..sources.archive import read_archive, remove_paths
from .fingerprints import differing, fingerprints

KEYS = ["season", "week"]
NEEDED = ["game_id", "season", "week", "home_team", "away_team", "home_score", "away_score", "result"]


def reached(weeks: list[tuple], changed: list[tuple], modes: list[int]) -> list[tuple]:
    """The slices, in week order, that hold games of a changed week: those of the widest window from it on, and with
    the season mode all later ones of its season. A week that is no longer played, or wasn't before,
    moves the windows of as many weeks behind it."""
    widest, out = max([1, *modes]), set()
    for week in changed:
        at = bisect_left(weeks, week)
        out.update(weeks[at : at + widest])
        if 0 in modes:
            out.update(w for w in weeks[at:] if w[0] == week[0])
    return sorted(out)


def looked_back(weeks: list[tuple], slices: list[tuple], modes: list[int]) -> tuple[tuple, tuple]:
    """The first and the last week whose games the slices need."""
    first = max(0, bisect_left(weeks, slices[0]) - max([1, *modes]) + 1)
    if 0 in modes:
        first = min(first, bisect_left(weeks, (slices[0][0],)))
    return weeks[first], slices[-1]


def refresh_slices(spark: SparkSession, path: str, games: DataFrame, resets=(True, 10, 20), tol: float = 1e-3, max_iter: int = 200) -> list[tuple]:
    """Brings ``srs_data`` of the games, kept at ``path`` by season and week, up to date; the slices written.

    Fingerprints of every week's played games, kept beside the product, tell which weeks changed since the last
    call: new ones, late games, corrections, games taken back. Only the slices that these reach are
    computed, from the weeks they look back to, and only their folders are replaced; all other files stay
    untouched. The fingerprints are written last, so a run that ends early is done again. With the games in folders by
    season (and week), only the folders looked back to are read. Weeks are few: they are held on the driver.
    """
    modes = sorted({reset_mode(r) for r in resets})
    played = games.where(F.col("result").isNotNull()).select(*NEEDED)
    new = fingerprints(played, KEYS).collect()
    marks, old = f"{path}.marks", None
    if read_archive(spark, path) is not None:
        held = read_archive(spark, marks)
        old = None if held is None else held.collect()
    schema = "season int, week int, _rows long, _sum string, _folded long"
    table = lambda rows: spark.createDataFrame([tuple(r) for r in rows], schema)
    weeks = sorted((r["season"], r["week"]) for r in new)
    found = differing(table(new), None if old is None else table(old), KEYS).collect()
    if not found:
        return []
    slices = weeks if old is None else reached(weeks, sorted((r["season"], r["week"]) for r in found), modes)
    if slices:
        low, high = looked_back(weeks, slices, modes)
        # seasons and weeks as literals, which prune folders
        inside = F.col("season").between(low[0], high[0]) & ~((F.col("season") == low[0]) & (F.col("week") < low[1])) & ~((F.col("season") == high[0]) & (F.col("week") > high[1]))
        rated = srs_data(played.where(inside), resets, tol, max_iter, slices=spark.createDataFrame(slices, "season int, week int"))
        writer = rated.repartition(*KEYS).write.partitionBy(*KEYS)
        writer.option("partitionOverwriteMode", "static" if old is None else "dynamic").mode("overwrite").parquet(path)
    remove_paths(spark, [f"{path}/season={r['season']}/week={r['week']}" for r in found if r["gone"]])
    table(new).coalesce(1).write.mode("overwrite").parquet(marks)
    return slices
