"""A league derived from the order tables: nations play each other monthly.

Scores and plays come from whole cents, never from sums of doubles, so every engine agrees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEAMS, PERIODS, FUTURE = 25, 80, 78
PERIOD = "(12 * (year(o_orderdate) - 1995) + month(o_orderdate) - 1)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def team_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(team_key, r, cents): order cents of a nation's customers in a month."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.expr(PERIOD).alias("r"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("team_key"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("team_key", "r").agg(F.sum("cents").alias("cents"))


def pairings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, home_key, away_key, home_team, away_team) of every scheduled game."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    grid = nation.select("k", "name", F.explode(F.sequence(F.lit(0), F.lit(PERIODS - 1))).alias("r"))
    grid = grid.withColumn("opp", F.pmod(F.col("r") - F.col("k"), F.lit(TEAMS))).where("k < opp")
    other = nation.select(F.col("k").alias("opp"), F.col("name").alias("opp_name"))
    even = F.col("r") % 2 == 0
    return grid.join(F.broadcast(other), "opp").select(
        "r",
        F.when(even, F.col("k")).otherwise(F.col("opp")).alias("home_key"),
        F.when(even, F.col("opp")).otherwise(F.col("k")).alias("away_key"),
        F.when(even, F.col("name")).otherwise(F.col("opp_name")).alias("home_team"),
        F.when(even, F.col("opp_name")).otherwise(F.col("name")).alias("away_team"),
    )


def _odds(x: str) -> str:
    return f"cast(case when ({x}) % 41 = 0 then null when ({x}) % 2 = 0 then 100 + ({x}) % 300 else -(100 + ({x}) % 300) end as double)"


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game, played or not, with the columns of a raw schedule."""
    t = team_periods(spark, sf_dir)
    games = pairings(spark, sf_dir)
    home = t.select("r", F.col("team_key").alias("home_key"), F.col("cents").alias("hc"))
    away = t.select("r", F.col("team_key").alias("away_key"), F.col("cents").alias("ac"))
    games = games.join(home, ["r", "home_key"], "left").join(away, ["r", "away_key"], "left")
    return games.selectExpr(
        "format_string('%d_%02d_%02d_%02d', 1995 + r div 12, r % 12 + 1, away_key, home_key) as game_id",
        "cast(1995 + r div 12 as int) as season",
        "cast(r % 12 + 1 as int) as week",
        "case when r % 12 + 1 <= 10 then 'REG' else 'WC' end as game_type",
        "date_add(make_date(cast(1995 + r div 12 as int), cast(r % 12 + 1 as int), 1), cast(home_key % 28 as int)) as gameday",
        "case when hc % 53 = 0 then null when hc is not null and ac is not null then format_string('%02d:%02d', 10 + hc % 12, ac % 60) end as gametime",
        "case when (home_key * away_key + r) % 11 = 0 then 'Neutral' else 'Home' end as location",
        "home_team",
        "away_team",
        f"cast(case when r < {FUTURE} then hc % 45 end as double) as home_score",
        f"cast(case when r < {FUTURE} then ac % 45 end as double) as away_score",
        f"cast(case when r < {FUTURE} then hc % 45 - ac % 45 end as double) as result",
        f"cast(case when r < {FUTURE} then hc % 45 + ac % 45 end as double) as total",
        "(hc % 29 - 14) / 2.0D as spread_line",
        "30 + (ac % 41) / 2.0D as total_line",
        f"{_odds('hc')} as home_spread_odds",
        f"{_odds('ac')} as away_spread_odds",
        f"{_odds('hc + 7')} as under_odds",
        f"{_odds('ac + 7')} as over_odds",
        f"{_odds('hc + 13')} as home_moneyline",
        f"{_odds('ac + 13')} as away_moneyline",
        *[f"cast(home_key as string) as {c}" for c in ("old_game_id", "gsis", "nfl_detail_id", "pfr", "pff", "espn", "ftn", "away_qb_id", "home_qb_id", "stadium_id")],
    )


def plays(spark: SparkSession, sf_dir: str, seasons: list[int] | None = None) -> DataFrame:
    """One row per line item whose customer's nation plays in the month of the order, of all seasons or some."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "cast(round(l_extendedprice * 100) as bigint) as px", "cast(round(l_tax * 100) as bigint) as tax"
    )
    orders = table(spark, sf_dir, "orders")
    if seasons is not None:
        orders = orders.where(_in_seasons(seasons))
    orders = orders.select("o_orderkey", "o_custkey", F.expr(PERIOD).alias("r"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    games = pairings(spark, sf_dir).selectExpr(
        "r", "home_team", "away_team", "home_key", "away_key", "format_string('%d_%02d_%02d_%02d', 1995 + r div 12, r % 12 + 1, away_key, home_key) as game_id",
        "cast(1995 + r div 12 as int) as season", "cast(r % 12 + 1 as int) as week",
    )
    sides = games.select(
        "r", "home_team", "away_team", "game_id", "season", "week",
        F.explode(F.array(F.struct(F.col("home_key").alias("k"), F.col("home_team").alias("posteam"), F.col("away_team").alias("defteam")), F.struct(F.col("away_key").alias("k"), F.col("away_team").alias("posteam"), F.col("home_team").alias("defteam")))).alias("s"),
    ).select("r", "home_team", "away_team", "game_id", "season", "week", "s.*")
    # orders meet their customers before the lines, which are many times as many, and a game's names are made once a game
    owned = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r", "k")
    joined = lines.join(owned, F.col("l_orderkey") == F.col("o_orderkey")).join(F.broadcast(sides), ["r", "k"])
    return joined.selectExpr(
        "game_id", "season", "week", "posteam", "defteam", "home_team", "away_team",
        "case when px % 101 = 0 then null else (px % 1001 - 500) / 100.0D end as epa",
        "case when px % 97 = 0 then null else (px % 700) / 100.0D end as ep",
        "case when px % 89 = 0 then null else (px % 101) / 100.0D end as vegas_wp",
        "cast(l_quantity <= 40 as int) as play", "cast(l_quantity > 40 as int) as special", "cast(l_returnflag = 'A' as int) as pass", "cast(l_returnflag = 'N' as int) as rush",
        "cast(tax >= 7 as int) as penalty",
        "case when px % 83 = 0 then null when l_quantity > 45 then 'field_goal' when l_quantity > 40 then 'kickoff' when l_returnflag = 'A' then 'pass' when l_returnflag = 'N' then 'run' else 'no_play' end as play_type",
        "l_orderkey as fixed_drive",
        "case l_orderkey % 4 when 0 then 'Touchdown' when 1 then 'Field goal' when 2 then 'Punt' else 'Turnover' end as fixed_drive_result",
        "cast(case when l_orderkey % 29 = 0 then null else l_orderkey % 3 = 0 end as int) as drive_inside20",
        "cast(l_returnflag = 'R' and px % 17 = 0 as int) as interception", "cast(l_returnflag = 'R' and px % 23 = 0 as int) as fumble_lost",
        "cast(px % 31 = 0 as int) as two_point_attempt",
        "case when px % 31 = 0 then case when px % 2 = 0 then 'success' else 'failure' end end as two_point_conv_result",
        "cast(px % 211 = 0 as int) as defensive_two_point_conv",
        "l_orderkey as series", "cast(l_orderkey % 5 < 3 as int) as series_success", "cast((l_linenumber - 1) % 4 + 1 as int) as down",
    )


STATS = ["passing_tds", "rushing_tds", "special_teams_tds", "def_tds", "fumble_recovery_tds", "passing_2pt_conversions", "rushing_2pt_conversions", "pat_att", "pat_made", "fg_att", "fg_made", "def_safeties"]
DIGITS = ["t % 5", "(t div 5) % 4", "(t div 20) % 2", "(t div 40) % 2", "(t div 80) % 2", "(t div 160) % 2", "(t div 320) % 2", "(t div 640) % 6", "least((t div 640) % 6, (t div 3840) % 7)", "(t div 26880) % 5", "least((t div 26880) % 5, (t div 134400) % 6)", "(t div 806400) % 2"]


def team_week_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per team and week: counting stats from the digits of the month's cents."""
    t = team_periods(spark, sf_dir).where(f"r between 0 and {PERIODS - 1}").withColumnRenamed("cents", "t")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("team_key"), F.col("n_name").alias("team"))
    return t.join(F.broadcast(nation), "team_key").selectExpr(
        "cast(1995 + r div 12 as int) as season", "cast(r % 12 + 1 as int) as week", "team", *[f"cast({d} as int) as {c}" for c, d in zip(STATS, DIGITS)]
    )


#: Which market segments' customers are players of which kind of statistics.
STAT_KINDS = {"offense": ("AUTOMOBILE", "BUILDING"), "defense": ("HOUSEHOLD", "MACHINERY"), "kicking": ("FURNITURE",)}


def player_weeks(spark: SparkSession, sf_dir: str, seasons: list[int] | None = None, stat: str | None = None) -> DataFrame:
    """One row per customer and month: orders and cents, and the opponent of the nation's team. ``seasons`` become dates
    that are pushed down to the scan of orders; ``stat`` takes the players of one kind."""
    orders = table(spark, sf_dir, "orders")
    if seasons is not None:
        orders = orders.where(_in_seasons(seasons))
    orders = orders.select("o_custkey", F.expr(PERIOD).alias("r"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    customers = table(spark, sf_dir, "customer")
    if stat is not None:
        if stat not in STAT_KINDS:
            raise ValueError(f"stat must be one of {', '.join(STAT_KINDS)}")
        customers = customers.where(F.col("c_mktsegment").isin(*STAT_KINDS[stat]))
    customers = customers.select("c_custkey", F.col("c_nationkey").alias("k"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("opp"), F.col("n_name").alias("opponent_team"))
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("r", "k", F.col("o_custkey").alias("player_id")).agg(F.count(F.lit(1)).alias("attempts"), F.sum("cents").alias("yards"))
    rows = rows.withColumn("opp", F.pmod(F.col("r") - F.col("k"), F.lit(TEAMS))).join(F.broadcast(nation), "opp")
    return rows.selectExpr("cast(1995 + r div 12 as int) as season", "cast(r % 12 + 1 as int) as week", "player_id", "opponent_team", "attempts", "yards")


def _in_seasons(seasons: list[int]):
    """Orders of the seasons, as ranges of dates that a scan can skip row groups by."""
    day = F.col("o_orderdate")
    out = F.lit(False)
    for s in sorted(set(seasons)):
        out = out | (day >= F.lit(f"{s}-01-01").cast("date")) & (day < F.lit(f"{s + 1}-01-01").cast("date"))
    return out


def write_plays(plays_: DataFrame, name: str, buckets: int = 32, path: str | None = None) -> DataFrame:
    """Plays as the table ``name``, in the warehouse or at ``path``: folders by season, and in each season the plays of a game in one of
    ``buckets`` buckets, sorted. Reading some seasons prunes folders, and whatever groups by game needs no exchange."""
    rows = plays_.repartition(buckets, "game_id")
    writer = rows.write.partitionBy("season").bucketBy(buckets, "game_id").sortBy("game_id").mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return plays_.sparkSession.table(name)


def load_plays(spark: SparkSession, name: str, seasons: list[int] | None = None) -> DataFrame:
    """The plays of a table that ``write_plays`` wrote, of all seasons or some."""
    rows = spark.table(name)
    return rows if seasons is None else rows.where(F.col("season").isin(list(seasons)))
