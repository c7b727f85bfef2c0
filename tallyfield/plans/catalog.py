"""The registered queries of the league engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import elo, features, games, ids, plays, scores, standings, stats
from ..session import shared_folder, ship_package
from ..sources import league
from ..sources.archive import folders_side_by_side
from . import incremental, kept, oracle
from .products import PATCHES, Run


def _rounded(df: DataFrame, digits: int = 6, shift: float = 0.0) -> DataFrame:
    """Doubles rounded for comparison; the shift keeps sums of decimals off the ties and off -0."""
    return df.select(*[F.round(F.col(c) + shift, digits).alias(c) if t == "double" else c for c, t in df.dtypes])


class League:
    """The derived sources and the products that several queries share, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark, self.sf_dir, self.schedules = spark, sf_dir, league.schedules(spark, sf_dir)
        self.games = games.clean_games(self.schedules, team_codes={"NATION_0": "NATION_00"})
        self.plain = games.clean_games(self.schedules)
        self.long = games.games_long(self.plain)
        self.plays = league.plays(spark, sf_dir)
        self.stats = league.team_week_stats(spark, sf_dir)
        self.players = league.player_weeks(spark, sf_dir)

    def written(self, name: str) -> DataFrame:
        """A product of a run of its own: it and all that it needs are derived once, written and read."""
        run = Run(self.spark, self.sf_dir, shared_folder(self.spark, "run"))
        run.build([name], keep=False)
        return run.read(name)

    def side_by_side(self, build: Callable[[League], DataFrame]) -> DataFrame:
        """What ``build`` makes of the league; folders that it writes on the way need no sort of a task's rows."""
        with folders_side_by_side(self.spark):
            return build(self)


def _elo(x: League, prior=None, games=None, **params) -> DataFrame:
    return elo.elo_history(x.schedules if games is None else games, prior, **{"home_advantage": 0.0, **params})


def _old(df: DataFrame) -> DataFrame:
    return df.where("season < 2000")


QUERIES = {
    "games_clean": lambda x: x.games.select("game_id", "season", "week", "week_seq", "game_type", "season_type", "gameday", "gametime", "location", "home_team", "away_team", "home_score", "away_score", "result", "winner", "total", "spread_line", "total_line"),
    "games_odds_prob": lambda x: _rounded(x.plain.select("game_id", *games.ODDS.values())),
    "games_time_of_day": lambda x: x.plain.select("game_id", "gametime", "time_of_day", "spreadCover", "totalCover"),
    "week_seq": lambda x: x.plain.select("season", "week", "week_seq").distinct(),
    "games_long": lambda x: x.long.select("game_id", "season", "week", "team", "opponent", "location", "locationID", "team_score", "opponent_score", "result", "spread_line", "winner"),
    "running_record": lambda x: _rounded(x.long.select("game_id", "season", "week", "team", "team_GP", "team_W", "team_L", "team_T", "team_PF", "team_PFG", "team_PA", "team_PAG")),
    "pair_pivot_wide": lambda x: games.pair_to_wide(x.long.select("game_id", "location", "team", "opponent", "team_score", "result"), check=False),
    "player_join": lambda x: games.players_with_games(x.players, x.long),
    "ids_cascade_game_team": lambda x: ids.add_game_ids(x.stats.join(x.long.select("game_id", "season", "week", "team"), ["season", "week", "team"]).select("game_id", "team", "pat_made"), x.schedules),
    "ids_cascade_week_team": lambda x: ids.add_game_ids(x.stats.select("season", "week", "team", "passing_tds"), x.schedules),
    "ids_cascade_home_away": lambda x: ids.add_game_ids(x.schedules.select("season", "week", "home_team", "away_team", "total"), x.schedules),
    "ids_cascade_week_opponent": lambda x: ids.add_game_ids(x.stats.select("season", "week", F.col("team").alias("opponent"), "fg_made"), x.schedules),
    "missing_keys": lambda x: incremental.missing_keys(x.schedules, _old(x.schedules), ["season", "week"]),
    "period_semi_slice": lambda x: incremental.last_periods(x.plain, x.plain.select("season", "week", "week_seq").distinct(), 11, 30).select("game_id", "season", "week"),
    "incremental_upsert": lambda x: incremental.replace_periods(x.schedules.where("season <= 1999").select("game_id", "season", "result"), x.schedules.where("season >= 1999").select("game_id", "season", "result", "total")),
    "epa_offense": lambda x: _rounded(plays.epa_ratings(x.plays, "offense"), shift=1e-9),
    "epa_defense": lambda x: _rounded(plays.epa_ratings(x.plays, "defense"), shift=1e-9),
    "epa_joined": lambda x: _rounded(plays.epa(x.plays), shift=1e-9),
    "epa_scaled": lambda x: _rounded(plays.epa_ratings(x.plays, "offense", scaled_wp=True), shift=1e-9),
    "turnovers": lambda x: plays.turnovers(x.long, x.plays),
    "turnovers_global_pairing": lambda x: plays.turnovers(x.long, x.plays, "global"),
    "redzone": lambda x: _rounded(plays.redzone(x.long, x.plays)),
    "redzone_first_match": lambda x: _rounded(plays.redzone(x.long, x.plays, "first")),
    "two_point": lambda x: scores.two_point(x.plays),
    "team_week_stats": lambda x: x.stats,
    "score_patches": lambda x: scores.corrected(scores.stat_columns(x.stats), PATCHES),
    "scores": lambda x: scores.scores(x.long, x.stats, x.plays, PATCHES),
    "series_weekly": lambda x: _rounded(plays.series(x.plays)),
    "series_ids": lambda x: _rounded(plays.series_with_ids(x.plays, x.schedules)),
    "stats_week_team_all": lambda x: ids.add_game_ids(stats.stats_by_level(x.stats, x.plain, league.STATS, "week", "team", "ALL"), x.schedules),
    "stats_season_team_reg": lambda x: stats.stats_by_level(x.stats, x.plain, league.STATS, "season", "team", "REG"),
    "stats_week_player_post": lambda x: stats.stats_by_level(x.players, x.plain, ["attempts", "yards"], "week", "player", "POST"),
    "stats_season_player_both": lambda x: stats.stats_by_level(x.players, x.plain, ["attempts", "yards"], "season", "player", "REG+POST"),
    "series_season": lambda x: _rounded(plays.series(x.plays, weekly=False)),
    "weekly_standings_season": lambda x: _rounded(standings.weekly_standings(x.written("games"), ratings=False)),
    "weekly_standings_roll10": lambda x: _rounded(standings.weekly_standings(x.written("games"), reset=10, ratings=False)),
    "weekly_standings_reg": lambda x: _rounded(standings.weekly_standings(x.written("games"), "REG", ratings=False)),
    "srs_season": lambda x: _rounded(standings.weekly_standings(x.written("games"), max_iter=100), 4),
    "srs_slice_weekly": lambda x: _rounded(standings.weekly_standings(x.written("games"), reset=10, max_iter=100).select("season", "week", "team", *standings.RATINGS), 4),
    "srs_multi_mode": lambda x: _rounded(standings.srs_data(x.written("games")), 4),
    "srs_17_modes": lambda x: _rounded(standings.srs_data(x.written("games"), [True, *range(5, 21)], max_iter=200), 4),
    "season_standings": lambda x: _rounded(standings.season_standings(x.plain, ratings=False)),
    "season_standings_ratings": lambda x: _rounded(standings.season_standings(x.written("games")), 4),
    "elo_full": lambda x: _rounded(_elo(x)),
    "elo_resume": lambda x: _rounded(_elo(x, prior=_elo(x, games=_old(x.schedules)))),
    "elo_hfa_margin": lambda x: _rounded(_elo(x, home_advantage=65.0, margin=True)),
    "elo_latest": lambda x: _rounded(elo.latest_ratings(_elo(x))),
    "team_form_lag": lambda x: _rounded(features.lagged(x.long.select("game_id", "season", "week", "team", "team_score"), ["team_score"]).drop("team_score_ewma_lag")),
    "team_ewma_lag": lambda x: _rounded(features.lagged(x.long.select("game_id", "season", "week", "team", "team_score"), ["team_score"]).select("game_id", "team", "team_score_ewma_lag")),
    "elo_stream": lambda x: _rounded(kept.elo_stream(x)),
    "srs_slices": lambda x: _rounded(kept.srs_slices(x), 4),
    "series_kept": lambda x: _rounded(x.side_by_side(kept.series_kept)),
    "stats_kept": kept.stats_kept,
    "epa_bucketed": lambda x: _rounded(kept.epa_bucketed(x), shift=1e-9),
    "player_kicking": kept.player_kicking,
    "model_long": lambda x: _rounded(x.written("model_long"), 4, shift=1e-9),
    "model_wide": lambda x: _rounded(x.written("model_wide"), 4, shift=1e-9),
}


def queries() -> dict:
    def bound(build):
        return lambda spark, sf_dir: build(League(spark, sf_dir))

    return {name: bound(build) for name, build in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.queries()
