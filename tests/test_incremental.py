"""Products kept current: slices, fingerprints, the graph of products, ratings and series from streams."""

import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tallyfield.operators import elo, ids, plays, standings
from tallyfield.operators import games as games_
from tallyfield.plans import fingerprints, products, slices
from tallyfield.sources import archive, league
from tallyfield.streaming import ratings, replace

SF = "/root/testdata/sf0.01"


def rows_of(df, digits=6):
    return sorted((tuple(round(x, digits) + 0.0 if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def schedule(spark, tmp_path_factory):
    """The cleaned games, written by season and week."""
    path = str(tmp_path_factory.mktemp("games") / "games")
    games_.clean_games(league.schedules(spark, SF)).write.partitionBy("season", "week").parquet(path)
    return spark.read.parquet(path)


def files_under(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


# ------------------------------------------------------------------ fingerprints


def test_fingerprints_see_content_not_order(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (2, "c", 2.0), (None, "d", 3.0)], "season int, team string, x double")
    marks = fingerprints.fingerprints(df, ["season"])
    found = lambda other: sorted(map(tuple, fingerprints.differing(fingerprints.fingerprints(other, ["season"]), marks, ["season"]).collect()), key=str)
    assert found(df.orderBy(F.desc("team")).repartition(3)) == []
    assert found(df.withColumn("x", F.when(F.col("team") == "b", 0.0).otherwise(F.col("x")))) == [(1, False)]
    assert found(df.union(df.where("season = 2"))) == [(2, False)]
    assert found(df.where("season is not null")) == [(None, True)]
    assert found(df.union(spark.createDataFrame([(5, "e", 1.0)], df.schema))) == [(5, False)]
    assert fingerprints.differing(marks, None, ["season"]).count() == 3


# ------------------------------------------------------------------ slices


def test_reach_of_a_week():
    weeks = [(1, w) for w in range(1, 6)] + [(2, w) for w in range(1, 6)]
    assert slices.reached(weeks, [(1, 5)], [3]) == [(1, 5), (2, 1), (2, 2)]
    assert slices.reached(weeks, [(1, 2)], [0]) == [(1, 2), (1, 3), (1, 4), (1, 5)]
    assert slices.reached(weeks, [(1, 4)], [0, 3]) == [(1, 4), (1, 5), (2, 1)]
    assert slices.reached(weeks, [(1, 9)], [2]) == [(2, 1), (2, 2)]  # a week that was taken back
    assert slices.looked_back(weeks, [(2, 2), (2, 3)], [3]) == ((1, 5), (2, 3))
    assert slices.looked_back(weeks, [(2, 4)], [0, 2]) == ((2, 1), (2, 4))


@pytest.mark.parametrize("resets", [(True, 4, 10), (6,)])
def test_slices_equal_a_full_build(spark, tmp_path, schedule, resets):
    path = str(tmp_path / "srs")
    full = lambda df: rows_of(standings.srs_data(df, resets, max_iter=50), 4)
    kept = lambda: spark.read.parquet(path)

    def step(df):
        before = files_under(path)
        written = slices.refresh_slices(spark, path, df, resets, max_iter=50)
        after = files_under(path)
        want = standings.srs_data(df, resets, max_iter=50)
        assert rows_of(kept().select(*want.columns), 4) == full(df)
        folders = {f"/season={s}/week={w}/" for s, w in written}
        assert all(after.get(f) == t for f, t in before.items() if not any(x in f for x in folders) and f in after)
        return written, set(before) - set(after)

    at = schedule.where("season < 1998 or season = 1998 and week <= 10")
    assert len(step(at)[0]) == 46
    assert step(at)[0] == []
    # the next week, across a season's start, and an unplayed one, which counts for nothing
    assert step(schedule.where("season < 1998 or season = 1998 and week <= 11"))[0] == [(1998, 11)]
    at = schedule.where("season <= 1998 or season = 1999 and week <= 2")
    assert step(at)[0] == [(1998, 12), (1999, 1), (1999, 2)]
    unplayed = schedule.where("season = 1999 and week = 3").withColumn("result", F.lit(None).cast("double"))
    assert step(at.unionByName(unplayed))[0] == []
    # a corrected result reaches the slices of its windows only
    late = at.withColumn("home_score", F.when((F.col("season") == 1996) & (F.col("week") == 7), F.col("home_score") + 3).otherwise(F.col("home_score")))
    written, _ = step(late)
    assert written[0] == (1996, 7) and written[-1] == ((1997, 4) if 10 in resets else (1996, 12))
    # a game that came late, and a week that is taken back whole
    one = late.where("season = 1995 and week = 3").agg(F.min("game_id")).first()[0]
    missing = late.where(F.col("game_id") != one)
    step(missing)
    assert step(late)[0][0] == (1995, 3)
    _, gone = step(late.where("not (season = 1997 and week = 5)"))
    assert any("/season=1997/week=5/" in f for f in gone)


def test_slices_read_the_weeks_looked_back_to(spark, tmp_path, schedule, monkeypatch):
    path, plans = str(tmp_path / "srs"), []
    slices.refresh_slices(spark, path, schedule.where("season < 1999"), (4,), max_iter=20)
    real = slices.srs_data
    monkeypatch.setattr(slices, "srs_data", lambda df, *a, **kw: (plans.append(sorted({tuple(r) for r in df.select("season", "week").distinct().collect()})), real(df, *a, **kw))[1])
    slices.refresh_slices(spark, path, schedule.where("season < 1999 or season = 1999 and week = 1"), (4,), max_iter=20)
    assert plans == [[(1998, 10), (1998, 11), (1998, 12), (1999, 1)]]


# ------------------------------------------------------------------ the graph of products


def test_order_of_products():
    graph = {n: products.Product(n, None, needs) for n, needs in (("a", ()), ("b", ("a",)), ("c", ("a", "b")), ("d", ("e",)), ("e", ("d",)))}
    assert [p.name for p in products.ordered(graph, ["c"])] == ["a", "b", "c"]
    for wanted in (["d"], ["x"]):
        with pytest.raises(ValueError):
            products.ordered(graph, wanted)


def copied(spark, tmp_path, change=None):
    """The raw tables in a folder of their own, lines and orders of one year changed where asked."""
    import shutil

    folder = tmp_path / "raw"
    folder.mkdir(exist_ok=True)
    for name in ("nation", "customer", "orders", "lineitem"):
        if not (folder / f"{name}.parquet").exists():
            shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", folder / f"{name}.parquet")
    if change:
        for name in change:
            held = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
            change[name](held).coalesce(1).write.mode("overwrite").parquet(str(folder / f"{name}.new"))
            if (folder / f"{name}.parquet").is_dir():
                shutil.rmtree(folder / f"{name}.parquet")
            else:
                (folder / f"{name}.parquet").unlink()
            (folder / f"{name}.new").rename(folder / f"{name}.parquet")
    return str(folder)


def test_one_call_builds_all_products_and_a_second_nothing(spark, tmp_path):
    source, folder = copied(spark, tmp_path), str(tmp_path / "products")
    run = products.Run(spark, source, folder)
    written = run.build()
    assert set(written) == set(products.PRODUCTS) and written["model_wide"] == list(range(1995, 2002))
    before = files_under(folder)
    assert products.Run(spark, source, folder).build() == {} and files_under(folder) == before
    assert run.manifest()["version"] == 1
    # touched files with the same rows are read, and nothing is written but the new state
    copied(spark, tmp_path, {"lineitem": lambda df: df.orderBy("l_comment") if "l_comment" in df.columns else df.orderBy("l_quantity")})
    assert run.build() == {} and run.manifest()["version"] == 2
    # lines of one year changed: what rests on schedules alone stays, model tables change from that year on
    year = spark.read.parquet(f"{source}/orders.parquet").where("year(o_orderdate) = 1998").select(F.col("o_orderkey").alias("l_orderkey")).distinct()

    def dearer(df):
        keys = year.withColumn("hit", F.lit(True))
        return df.join(keys, "l_orderkey", "left").withColumn("l_extendedprice", F.when(F.col("hit"), F.col("l_extendedprice") + 3.17).otherwise(F.col("l_extendedprice"))).drop("hit")

    copied(spark, tmp_path, {"lineitem": dearer})
    before = files_under(folder)
    written = run.build()
    assert written["plays"] == written["epa"] == [1998] and not {"schedules", "games", "elo", "srs"} & set(written)
    assert written["model_long"] == [1998, 1999, 2000, 2001]
    after = files_under(folder)
    assert all(after[f] == t for f, t in before.items() if "/season=199" in f and not any(f"season={y}" in f for y in (1998, 1999)))
    # and everything equals a build from nothing
    other = products.Run(spark, source, str(tmp_path / "anew"))
    other.build(["model_wide"])
    for name in ("plays", "epa", "series", "redzone", "model_long", "model_wide"):
        assert rows_of(run.read(name), 4) == rows_of(other.read(name), 4)
    assert set(run.build(["elo"], full=True)) == {"schedules", "elo"}


def test_wide_table_reads_the_lines_twice_at_most(spark, monkeypatch):
    from tallyfield.plans import catalog

    scans = []
    real = products.Run._write
    monkeypatch.setattr(products.Run, "_write", lambda self, name, rows, stale: (scans.append(rows._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")), real(self, name, rows, stale))[1])
    out = catalog.queries()["model_wide"](spark, "/root/testdata/sf0.001")
    assert sum(scans) == 1 and "lineitem" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def write_plans(spark, monkeypatch):
    """The plans that an insert by season has whenever a product or folder is written."""
    spark.sql("create table by_season (x int, season int) using parquet partitioned by (season)")
    plan, real, found = lambda: spark.sql("explain insert into by_season select 1, cast(id as int) from range(9)").first()[0], DataFrameWriter.parquet, []
    assert "Sort [season" in plan() or "Sort [cast" in plan()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **kw: (found.append((path, plan())), real(self, path, *a, **kw))[1])
    yield found
    spark.sql("drop table by_season")


def test_products_are_written_without_sorting_their_rows(spark, tmp_path, write_plans):
    conf = {k: spark.conf.get(k, None) for k in (archive._WRITERS, archive._ROW_GROUP)}
    products.Run(spark, "/root/testdata/sf0.001", str(tmp_path / "products")).build(["epa"], keep=False)
    assert [os.path.basename(p) for p, _ in write_plans] == ["plays", "epa"]
    assert all("WriteFiles" in plan and "Sort" not in plan for _, plan in write_plans)
    assert {k: spark.conf.get(k, None) for k in conf} == conf


def test_series_follow_plays_that_are_written_without_sorting_them(spark, write_plans):
    from tallyfield.plans import catalog

    out = catalog.queries()["series_kept"](spark, "/root/testdata/sf0.001")
    by_season = [plan for path, plan in write_plans if os.path.basename(path) in ("plays", "series")]
    assert len(by_season) == 7 and all("WriteFiles" in plan and "Sort" not in plan for plan in by_season)
    want = catalog.queries()["series_weekly"](spark, "/root/testdata/sf0.001")
    assert rows_of(out.select(want.columns)) == rows_of(want)


@pytest.mark.parametrize("folders", [1, 3, 32])
def test_folders_side_by_side_keep_every_row(spark, tmp_path, monkeypatch, folders):
    # more seasons than open files, a null one, null texts, rows that come twice, no rows in some tasks
    monkeypatch.setattr(archive, "FOLDERS", folders)
    rows = [(None if k % 7 == 6 else 1995 + k % 7, None if k % 5 == 0 else f"team {k % 3}", k % 11) for k in range(200)]
    df = spark.createDataFrame(rows, "season int, team string, x int").repartition(3)
    run = products.Run(spark, "", str(tmp_path))
    run._write("p", df, None)
    columns = ["season", "team", "x"]
    assert rows_of(run.read("p").select(columns)) == rows_of(df)
    run._write("p", df.withColumn("x", F.col("x") + 1), [1996])
    assert rows_of(run.read("p").select(columns)) == rows_of(df.select("season", "team", (F.col("x") + F.when(F.col("season") == 1996, 1).otherwise(0)).alias("x")))
    run._write("none", df.where("season < 0"), None)
    assert not any(f"season={s}" in f for s in range(1995, 2001) for f in files_under(run.path("none")))


def test_folders_side_by_side_leave_the_session_as_it_was(spark):
    held = lambda: [spark.conf.get(k, None) for k in (archive._WRITERS, archive._ROW_GROUP)]
    with pytest.raises(KeyError), archive.folders_side_by_side(spark):
        assert held() == [str(archive.FOLDERS), str(2**27 // archive.FOLDERS)]
        raise KeyError
    assert held() == [None, None]
    # a session's own row groups are shared, its own number of files stays
    spark.conf.set(archive._ROW_GROUP, str(2**25))
    try:
        with archive.folders_side_by_side(spark):
            assert held() == [str(archive.FOLDERS), str(2**25 // archive.FOLDERS)]
        assert held() == [None, str(2**25)]
        for files in ("5", "0"):
            spark.conf.set(archive._WRITERS, files)
            with archive.folders_side_by_side(spark):
                assert held() == [files, str(2**25)]
            assert held() == [files, str(2**25)]
    finally:
        spark.conf.unset(archive._ROW_GROUP)
        spark.conf.unset(archive._WRITERS)


# ------------------------------------------------------------------ streams


def test_elo_stream_goes_on_after_restarts(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("games", "rated", "mark"))
    schedule = league.schedules(spark, SF).select("game_id", "season", "week", "gameday", "home_team", "away_team", "home_score", "away_score", "location")
    schema = schedule.schema.simpleString()[7:-1].replace(":", " ")
    want = lambda df: rows_of(elo.elo_history(df, None, home_advantage=0.0, margin=True))
    got = lambda: rows_of(spark.read.parquet(target))
    steps = ["season < 1997", "season = 1997 and week <= 5", "season = 1997 and week > 5 or season > 1997"]
    for k, part in enumerate(steps):
        schedule.where(part).write.mode("append").parquet(source)
        ratings.follow_elo(spark, source, schema, target, mark, home_advantage=0.0, margin=True).awaitTermination()
        assert got() == want(schedule.where(" or ".join(f"({s})" for s in steps[: k + 1])))
        # the same games in another file change nothing
        schedule.where(part).write.mode("append").parquet(source)
        ratings.follow_elo(spark, source, schema, target, mark, home_advantage=0.0, margin=True).awaitTermination()
    assert got() == want(schedule)


def test_series_follow_new_seasons_only(spark, tmp_path, monkeypatch):
    source, target, mark = (str(tmp_path / n) for n in ("plays", "series", "mark"))
    rows = league.plays(spark, "/root/testdata/sf0.001").select("game_id", "season", "week", "posteam", "defteam", "series", "series_success", "down")
    schema = rows.schema.simpleString()[7:-1].replace(":", " ")
    read = []
    real = replace.seasons_of
    monkeypatch.setattr(replace, "seasons_of", lambda *a, **kw: (read.append((a[3], real(*a, **kw)._jdf.queryExecution().executedPlan().toString())), real(*a, **kw))[1])
    for part, seasons in (("season < 1997", [1995, 1996]), ("season = 1997 and week < 6", [1997]), ("season = 1997 and week >= 6", [1997])):
        rows.where(part).write.mode("append").partitionBy("season").parquet(source)
        before = files_under(target)
        replace.follow_series(spark, source, schema, target, mark).awaitTermination()
        assert read[-1][0] == seasons and "season" in read[-1][1].split("PartitionFilters:")[1].split("]")[0]
        assert all(files_under(target)[f] == t for f, t in before.items() if not any(f"season={s}" in f for s in seasons))
    want = plays.series(rows.where("season < 1998"))
    assert rows_of(spark.read.parquet(target).select(*want.columns)) == rows_of(want)
    log = spark.read.parquet(f"{target}.applied").orderBy("batch")
    assert [(r["batch"], r["seasons"]) for r in log.collect()] == [(0, [1995, 1996]), (1, [1997]), (2, [1997])]
    # nothing new, and a batch that is in the log
    replace.follow_series(spark, source, schema, target, mark).awaitTermination()
    before = files_under(target)
    replace.follow_series(spark, source, schema, target, str(tmp_path / "another mark")).awaitTermination()
    assert len(read) == 3 and files_under(target) == before


# ------------------------------------------------------------------ pruned sources, order


def test_plays_of_some_seasons_need_no_exchange(spark):
    small = "/root/testdata/sf0.001"
    name = "plays_of_a_test"
    league.write_plays(league.plays(spark, small), name, 4)
    try:
        some = league.load_plays(spark, name, [1996, 1998])
        plan = plays.epa(some)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert "season" in plan.split("PartitionFilters:")[1].split("]")[0]
        want = plays.epa(league.plays(spark, small).where("season in (1996, 1998)"))
        assert rows_of(plays.epa(some).select(*want.columns), 4) == rows_of(want, 4)
        assert rows_of(plays.epa(league.plays(spark, small, [1996, 1998])), 4) == rows_of(want, 4)
    finally:
        spark.sql(f"drop table {name}")


def test_players_of_a_kind_and_season(spark):
    everyone = rows_of(league.player_weeks(spark, SF))
    kinds = [rows_of(league.player_weeks(spark, SF, stat=k)) for k in league.STAT_KINDS]
    assert sorted(sum(kinds, []), key=str) == everyone and all(kinds)
    some = league.player_weeks(spark, SF, seasons=[1996, 1999], stat="kicking")
    assert rows_of(some) == [r for r in kinds[2] if r[0] in (1996, 1999)]
    assert "o_orderdate" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]
    with pytest.raises(ValueError):
        league.player_weeks(spark, SF, stat="coaching")


def test_rows_keep_their_order_over_partitions(spark, tmp_path):
    schedule = league.schedules(spark, SF)
    rows = [(r["season"], r["week"], t, k) for k, r in enumerate(schedule.orderBy(F.rand(3)).collect()) for t in (r["away_team"], r["home_team"])]
    rows += [(1999, 1, "no team", -1)]
    spark.createDataFrame(rows, "season int, week int, team string, k int").repartition(7).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    assert df.rdd.getNumPartitions() > 1
    assert [r["n"] for r in ids.row_numbers(df, "n").collect()] == list(range(len(rows)))
    got = ids.add_game_ids(df, schedule, preserve_order=True)
    assert got.columns == [*ids.add_game_ids(df, schedule).columns]
    assert [(r["season"], r["week"], r["team"], r["k"]) for r in got.collect()] == [tuple(r) for r in df.collect() if r["k"] >= 0]
    assert ids.row_numbers(df.limit(0), "n").count() == 0
