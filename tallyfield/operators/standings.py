"""Standings and ratings of weeks: of the season to date, or of the last N played weeks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import require_columns
from .games import unpivot_sides

NEEDED = ["game_id", "season", "week", "home_team", "away_team", "home_score", "away_score", "result", "location"]
RATINGS = ["MOV", "SOS", "SRS", "OSRS", "DSRS"]


def reset_mode(reset) -> int:
    """0 for season to date, else the number of periods of the rolling window."""
    if reset is True:
        return 0
    if reset is False:
        return 20
    if isinstance(reset, (int, float)) and reset > 0 and int(reset) == reset:
        return int(reset)
    raise ValueError("reset must be True, False or a positive whole number")


def week_grid(games: DataFrame) -> DataFrame:
    """(season, week, idx, last, top): the weeks with a played game in dense order, the last of each season and of
    all. A few rows a year, numbered in one task."""
    played = games.where(F.col("result").isNotNull())
    grid = played.select("season", "week").distinct().withColumn("idx", F.row_number().over(Window.orderBy("season", "week")))
    return grid.withColumn("last", F.max("idx").over(Window.partitionBy("season"))).withColumn("top", F.max("idx").over(Window.partitionBy()))


SUMS = ["games", "wins", "losses", "ties", "pf", "pa"]


def _tables(n, wins, losses, ties, pf, pa) -> list:
    """The columns of a table from its sums."""
    pf, pa = F.coalesce(pf, F.lit(0.0)), F.coalesce(pa, F.lit(0.0))
    return [
        n.alias("games"), wins.alias("wins"), wins.alias("true_wins"), losses.alias("losses"), ties.alias("ties"),
        pf.alias("pf"), pa.alias("pa"), (pf - pa).alias("pd"), (wins / n).alias("win_pct"),
    ]


def _sums() -> list:
    return [
        F.count(F.lit(1)), F.count(F.when(F.col("result") > 0, 1)), F.count(F.when(F.col("result") < 0, 1)),
        F.count(F.when(F.col("result") == 0, 1)), F.sum("team_score"), F.sum("opponent_score"),
    ]


def summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*_tables(*_sums()))


def period_tables(games: DataFrame, mode: int) -> DataFrame:
    """The table of every week: of its season up to it (mode 0), or of the ``mode`` played weeks that end with it.

    Each team's games are added up by week once. Its weeks without a game get a row while the frame still reaches
    back to one, so that a frame's sums are a running sum less the one ``mode`` rows before: two lookups a
    row, whatever the frame's length, and no copy of a game. Sums of fractions may differ in their last digits.
    """
    grid = F.broadcast(week_grid(games))
    long = unpivot_sides(games.where(F.col("result").isNotNull()), invert=("result",))
    weeks = long.join(grid, ["season", "week"]).groupBy("team", "season", "idx", "last", "top").agg(*[x.alias(n) for x, n in zip(_sums(), SUMS)])
    frame = ["team", "season"] if mode == 0 else ["team"]
    order = Window.partitionBy(*frame).orderBy("idx")
    end = F.col("last") if mode == 0 else F.least(F.col("idx") + mode - 1, F.col("top"))
    to = F.least(end, F.coalesce(F.lead("idx").over(order) - 1, end)) if mode == 0 else F.coalesce(F.lead("idx").over(order) - 1, end)
    dense = weeks.withColumn("to", to).select("team", "season", F.posexplode(F.sequence("idx", "to")).alias("k", "e"), *SUMS)
    dense = dense.select("team", "season", "e", *[F.when(F.col("k") == 0, F.col(c)).otherwise(F.lit(0)).alias(c) for c in SUMS])
    w = Window.partitionBy(*frame).orderBy("e")
    running = dense.select("team", "e", *[F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c) for c in SUMS])
    if mode:
        w = Window.partitionBy("team").orderBy("e")
        running = running.select("team", "e", *[(F.col(c) - F.coalesce(F.lag(c, mode).over(w), F.lit(0))).alias(c) for c in SUMS]).where("games > 0")
    names = week_grid(games).select("season", "week", F.col("idx").alias("e"))
    return running.join(F.broadcast(names), "e").select("season", "week", "team", *_tables(*map(F.col, SUMS)))


def rate(team: np.ndarray, opp: np.ndarray, score: np.ndarray, result: np.ndarray, k: int, tol: float, max_iter: int) -> np.ndarray:
    """Ratings of the teams 0..k-1, a column for each of ``RATINGS``, by simultaneous updates: every new value comes
    from the last round's. Early slices don't settle, so the number of rounds is part of the result."""
    n = np.bincount(team, minlength=k).astype(float)
    mean = lambda x: np.bincount(team, weights=x, minlength=k) / n
    mov, ppg = mean(result), mean(score)
    league = score.sum() / n.sum()
    average = score.mean()
    sos, srs = np.zeros(k), mov.copy()
    osrs = ppg - league
    dsrs = srs - osrs
    for _ in range(max_iter):
        new_sos, new_srs = mean(srs[opp]), mean(result + srs[opp])
        new_osrs = mean(score + dsrs[opp] - average)
        new_dsrs = new_srs - new_osrs
        delta = max(np.abs(new_srs - srs).max(), np.abs(new_osrs - osrs).max(), np.abs(new_dsrs - dsrs).max())
        sos, srs, osrs, dsrs = new_sos, new_srs, new_osrs, new_dsrs
        if delta < tol:
            break
    return np.column_stack([mov, sos, srs, osrs, dsrs])


def srs_of_slice(f: pd.DataFrame, tol: float = 1e-3, max_iter: int = 100) -> pd.DataFrame:
    """Ratings of one slice of team rows."""
    names, team = np.unique(f["team"].to_numpy(dtype=object).astype(str), return_inverse=True)
    opp = np.searchsorted(names, f["opponent"].to_numpy(dtype=object).astype(str))
    score, result = (f[c].to_numpy(dtype=float) for c in ("team_score", "result"))
    return pd.DataFrame(rate(team, opp, score, result, len(names), tol, max_iter), columns=RATINGS).assign(team=names)


def srs_ratings(rows: DataFrame, keys: list[str], tol: float = 1e-3, max_iter: int = 100) -> DataFrame:
    """Ratings of every slice, each in one call: a slice holds the games of one season or window."""
    require_columns(rows, [*keys, "team", "opponent", "team_score", "opponent_score", "result"])

    def rate(key, f):
        out = srs_of_slice(f, tol, max_iter)
        for name, value in zip(keys, key):
            out.insert(0, name, value)
        return out[[*keys, "team", *RATINGS]]

    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", team string, " + ", ".join(f"{r} double" for r in RATINGS)
    return rows.select(*keys, "team", "opponent", "team_score", "opponent_score", "result").groupBy(*keys).applyInPandas(rate, schema)


def ending_windows(games: DataFrame, modes: list[int], slices: DataFrame | None = None) -> DataFrame:
    """(e, idx, season, week, home_team, away_team, home_score, away_score, result): for each played week ``e`` the
    games of the widest window that ends with it, and of its season where mode 0 is asked for. All modes are
    ends of this one window, so a game is copied once for each week it reaches, not for each mode.
    ``slices`` (season, week) are the weeks wanted, all without it."""
    weeks = week_grid(games)
    grid = F.broadcast(weeks)
    reach = F.col("idx") + max([1, *modes]) - 1
    to = F.least(F.greatest(reach, F.col("last")) if 0 in modes else reach, F.col("top"))
    rows = games.where(F.col("result").isNotNull()).join(grid, ["season", "week"])
    out = rows.select(F.explode(F.sequence(F.col("idx"), to)).alias("e"), "idx", "season", "week", "home_team", "away_team", *[F.col(c).cast("double").alias(c) for c in ("home_score", "away_score", "result")])
    if slices is None:
        return out
    return out.join(F.broadcast(weeks.join(slices, ["season", "week"]).select(F.col("idx").alias("e"))), "e", "left_semi")


def rated_windows(games: DataFrame, modes: list[int], shown: int | None, tol: float, max_iter: int, slices: DataFrame | None = None) -> DataFrame:
    """Per week and team the ratings of every mode, with a mode's length as a suffix (none for mode 0 and for a single
    one), and the table of the mode ``shown``. One group a week rates each mode as a suffix of its window."""
    types, tables = dict(games.dtypes), ["games", "wins", "true_wins", "losses", "ties", "pf", "pa", "pd", "win_pct"]
    names = [r if m == 0 or len(modes) == 1 else f"{r}_{m}" for m in modes for r in RATINGS]
    shown_columns = tables if shown is not None else []
    schema = f"season {types['season']}, week {types['week']}, team string, "
    schema += ", ".join([f"{c} {'long' if k < 5 else 'double'}" for k, c in enumerate(shown_columns)] + [f"{c} double" for c in names])

    def run(key, f):
        f = f.sort_values("idx", kind="stable")
        e, last = key[0], f.iloc[-1]
        home, away = (f[c].to_numpy(dtype=object).astype(str) for c in ("home_team", "away_team"))
        teams, numbers = np.unique(np.concatenate([home, away]), return_inverse=True)
        n, idx, own = len(f), f["idx"].to_numpy(), (f["season"] == last["season"]).to_numpy()
        team, opp = numbers, np.concatenate([numbers[n:], numbers[:n]])
        hs, as_, res = (f[c].to_numpy(dtype=float) for c in ("home_score", "away_score", "result"))
        score, against, result = np.concatenate([hs, as_]), np.concatenate([as_, hs]), np.concatenate([res, -res])
        out = np.full((len(teams), len(names)), np.nan)
        shown_of, there = np.zeros((len(teams), 9)), np.zeros(len(teams), dtype=bool)
        for k, m in enumerate(modes):
            inside = np.tile(own if m == 0 else idx > e - m, 2)
            present, t = np.unique(team[inside], return_inverse=True)
            there[present] = True
            o = np.searchsorted(present, opp[inside])
            out[present, 5 * k : 5 * k + 5] = rate(t, o, score[inside], result[inside], len(present), tol, max_iter)
            if m == shown:
                add = lambda x: np.bincount(t, weights=np.nan_to_num(x[inside]), minlength=len(present))  # noqa: E731,B023
                games_, wins, pf, pa = add(np.ones(2 * n)), add(result > 0), add(score), add(against)
                shown_of[present] = np.column_stack([games_, wins, wins, add(result < 0), add(result == 0), pf, pa, pf - pa, wins / games_])
        held = pd.DataFrame(out, columns=names)
        for k, c in enumerate(shown_columns):
            held.insert(k, c, shown_of[:, k].astype(np.int64) if k < 5 else shown_of[:, k])
        held.insert(0, "team", teams)
        held.insert(0, "week", last["week"])
        held.insert(0, "season", last["season"])
        if shown is not None:
            there = shown_of[:, 0] > 0
        return held[there]

    return ending_windows(games, modes, slices).groupBy("e").applyInPandas(run, schema)


def weekly_standings(games: DataFrame, season_type: str = "ALL", reset=True, tol: float = 1e-3, max_iter: int = 100, ratings: bool = True) -> DataFrame:
    require_columns(games, NEEDED)
    kind = season_type.upper()
    if kind not in ("ALL", "REG", "POST"):
        raise ValueError("season_type must be ALL, REG or POST")
    games = games if kind == "ALL" else games.where(F.col("season_type") == kind)
    mode = reset_mode(reset)
    return rated_windows(games, [mode], mode, tol, max_iter) if ratings else period_tables(games, mode)


def srs_data(games: DataFrame, resets=(True, 10, 20), tol: float = 1e-3, max_iter: int = 100, slices: DataFrame | None = None) -> DataFrame:
    """All reset modes in one pass: table and ratings of the season mode, and each rolling mode's ratings
    with its length as a suffix. Without the season mode the teams of any window have rows. ``slices`` (season,
    week) limits the weeks computed; the games have to reach as far back as these look."""
    modes = sorted({reset_mode(r) for r in resets})
    out = rated_windows(games, modes, 0 if 0 in modes else None, tol, max_iter, slices)
    if len(modes) == 1 and modes[0]:
        out = out.withColumnsRenamed({r: f"{r}_{modes[0]}" for r in RATINGS})
    return out.drop("true_wins")


def season_standings(games: DataFrame, tol: float = 1e-3, max_iter: int = 100, ratings: bool = True, check: bool = False) -> DataFrame:
    """Regular-season tables with strength of victory (mean win share of beaten opponents) and of
    schedule (of all opponents, ``schedule_share``), and the season's ratings before ``sov``. ``check``
    raises, after a job, if no regular-season game has been played."""
    require_columns(games, ["season", "season_type", "home_team", "away_team", "home_score", "away_score", "result"])
    rows = unpivot_sides(games.where((F.col("season_type") == "REG") & F.col("result").isNotNull()), invert=("result",))
    rows = rows.select("season", "team", "opponent", "team_score", "opponent_score", "result")
    if check and rows.isEmpty():
        raise ValueError("no regular-season game has been played")
    base = summary(rows, ["season", "team"]).drop("true_wins")
    share = base.select("season", F.col("team").alias("opponent"), F.col("wins").alias("w"), F.col("games").alias("g"))
    met = rows.join(share, ["season", "opponent"]).groupBy("season", "team").agg(
        (F.sum(F.when(F.col("result") > 0, F.col("w"))) / F.sum(F.when(F.col("result") > 0, F.col("g")))).alias("sov"), (F.sum("w") / F.sum("g")).alias("schedule_share")
    )
    out = base
    if ratings:
        out = out.join(srs_ratings(rows, ["season"], tol, max_iter), ["season", "team"], "left")
    return out.join(met, ["season", "team"], "left")
