"""The run: products as a graph, each derived once, written by season and read by those that need it."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import elo, features, games, plays, scores, standings
from ..sources import league
from ..sources.archive import folder_state, folders_side_by_side, read_archive, remove_paths
from .fingerprints import fingerprints


@dataclass(frozen=True)
class Product:
    """``build`` makes the rows from the products it needs (for a source, from the session and the folder).

    ``reach`` says which seasons a changed season of an input changes: ``season`` is itself alone, and the build gets
    only the changed seasons of its inputs; ``onward`` is itself and all later ones, and the build gets all seasons.
    """

    name: str
    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    reach: str = "season"
    tables: tuple[str, ...] = field(default=())  # the raw tables of a source


def ordered(products: dict[str, Product], wanted: list[str]) -> list[Product]:
    """The wanted products and all they need, each behind its needs; raises for unknown names and circles."""
    out, open_ = [], []

    def visit(name: str) -> None:
        if name in open_:
            raise ValueError(f"products in a circle: {' -> '.join([*open_, name])}")
        if name not in products:
            raise ValueError(f"unknown product {name}")
        if products[name] not in out:
            open_.append(name)
            for need in products[name].needs:
                visit(need)
            open_.pop()
            out.append(products[name])

    for name in wanted:
        visit(name)
    return out


def _by_season(rows: DataFrame) -> dict[str, list]:
    return {str(r["season"]): list(r)[1:] for r in fingerprints(rows, ["season"]).collect()}


def _unequal(new: dict[str, list], old: dict[str, list]) -> list[int]:
    return sorted(int(s) for s in {*new, *old} if new.get(s) != old.get(s))


class Run:
    """The products under ``folder``, from the raw tables in ``source``; every product has a season, which is never null.

    ``build`` brings the wanted products up to date and returns what it wrote, by product the seasons. What was
    written is told by a manifest: the state of a source's files, and for each product the fingerprint of each
    season's rows. A source whose files are as they were isn't read. Else only seasons whose rows changed are
    written, and only what they reach is computed downstream; a product that comes out as before changes nothing behind
    it. The manifest is written last, a new version each time, so a run that ends early is done again by the
    next. ``full`` computes everything anew.
    """

    def __init__(self, spark: SparkSession, source: str, folder: str, products: dict[str, Product] | None = None):
        self.spark, self.source, self.folder = spark, source, folder
        self.products = PRODUCTS if products is None else products

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def manifest(self) -> dict:
        """The latest version, or an empty one."""
        held = read_archive(self.spark, f"{self.folder}/manifest")
        last = None if held is None else held.orderBy(F.desc("version")).first()
        return {"version": 0, "products": {}} if last is None else {"version": last["version"], "products": json.loads(last["products"])}

    def _marks(self, name: str) -> dict[str, list]:
        return _by_season(self.read(name))

    def _write(self, name: str, rows: DataFrame, stale: list[int] | None) -> None:
        """Replaces the stale seasons' folders, or everything."""
        if stale is not None:
            remove_paths(self.spark, [f"{self.path(name)}/season={s}" for s in stale])
            rows = rows.where(F.col("season").isin(stale))
        with folders_side_by_side(self.spark):
            rows.write.mode("overwrite" if stale is None else "append").partitionBy("season").parquet(self.path(name))

    def build(self, wanted: list[str] | None = None, full: bool = False, keep: bool = True) -> dict[str, list[int]]:
        """Without ``keep`` the products are for this use alone: no fingerprints are taken and no manifest is written."""
        held = self.manifest()
        known, changed, written = dict(held["products"]), {}, {}
        for product in ordered(self.products, wanted or list(self.products)):
            name, old = product.name, None if full else known.get(product.name)
            state = {t: folder_state(self.spark, f"{self.source}/{t}.parquet") for t in product.tables}
            stale = self._stale(product, old, state, changed, known)
            changed[name] = []
            if stale == [] and state == old["files"]:
                continue
            before = {} if old is None else old["seasons"]
            marks = before
            if stale != []:
                self._write(name, self._rows(product, stale), stale)
                marks = self._marks(name) if keep else {}
                changed[name] = _unequal(marks, before)
                written[name] = sorted(map(int, marks)) if stale is None else stale
            known[name] = {"files": state, "seasons": marks}
        if keep and known != held["products"]:
            row = (held["version"] + 1, datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC"), json.dumps(known))
            self.spark.createDataFrame([row], "version int, written string, products string").coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        return written

    def _stale(self, product: Product, old: dict | None, state: dict, changed: dict[str, list[int]], known: dict) -> list[int] | None:
        """The seasons to compute, None for all."""
        if old is None:
            return None
        if not product.needs:
            # where files changed, the rows are fingerprinted as they are derived: only changed seasons are written
            return [] if state == old["files"] else _unequal(_by_season(product.build(self.spark, self.source)), old["seasons"])
        seasons = sorted({s for need in product.needs for s in changed[need]})
        if seasons and product.reach == "onward":
            seasons = sorted({*seasons, *(int(s) for need in product.needs for s in known[need]["seasons"] if int(s) >= seasons[0])})
        return seasons

    def _rows(self, product: Product, stale: list[int] | None) -> DataFrame:
        if not product.needs:
            return product.build(self.spark, self.source)
        inputs = [self.read(need) for need in product.needs]
        if stale is not None and product.reach == "season":
            inputs = [x.where(F.col("season").isin(stale)) for x in inputs]
        return product.build(*inputs)


def _elo(schedules: DataFrame) -> DataFrame:
    return elo.elo_history(schedules, None, home_advantage=0.0)


def _srs(games_: DataFrame) -> DataFrame:
    return standings.srs_data(games_, [True])


def _wide(long: DataFrame, games_: DataFrame) -> DataFrame:
    return features.model_wide(long, games_.select("game_id", "season", "week", "week_seq", "home_team", "away_team", "result"))


#: Teams and weeks of the corrections that the score product takes in.
PATCHES = ((1996, 3, "NATION_4", {"rushing_tds": 1, "pat_att": 2, "pat_made": 2}), (1998, 7, "NATION_11", {"passing_tds": 3, "td_special": 0}))

_DERIVED = ("orders", "customer", "nation")
PRODUCTS = {
    p.name: p
    for p in (
        Product("schedules", league.schedules, tables=_DERIVED),
        Product("plays", league.plays, tables=("lineitem", *_DERIVED)),
        Product("team_stats", league.team_week_stats, tables=_DERIVED),
        Product("players", league.player_weeks, tables=_DERIVED),
        # week numbers go on through seasons, so an earlier season's weeks move the later ones'
        Product("games", games.clean_games, ("schedules",), "onward"),
        Product("games_long", games.games_long, ("games",)),
        Product("elo", _elo, ("schedules",), "onward"),
        Product("srs", _srs, ("games",)),
        Product("season_standings", standings.season_standings, ("games",)),
        Product("epa", plays.epa, ("plays",)),
        Product("scores", lambda long, stats, rows: scores.scores(long, stats, rows, PATCHES), ("games_long", "team_stats", "plays")),
        Product("series", plays.series, ("plays",)),
        Product("turnovers", plays.turnovers, ("games_long", "plays")),
        Product("redzone", plays.redzone, ("games_long", "plays")),
        Product("player_games", games.players_with_games, ("players", "games_long")),
        Product("model_long", features.model_long, ("games_long", "elo", "srs", "epa", "scores", "series", "turnovers", "redzone"), "onward"),
        Product("model_wide", _wide, ("model_long", "games")),
    )
}
