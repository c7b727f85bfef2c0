"""Joins that move few rows: sieves, keys gathered in one shuffle, tables that go in time."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tallyfield.llm.common import noting, saved, sieve, sifted
from tallyfield.llm.jaccard_join import _gathered
from tallyfield.llm.suffix_repeats import _recurring, repeat_report


def test_a_sieve_parts_rows_and_loses_none(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("k"), F.lit("x").alias("word"))
    keys = rows.where("id % 100 = 3").select("id", "k")
    unsure, sure = sifted(rows, sieve(keys, "id", "k"), "id", "k")
    assert unsure.columns == sure.columns == rows.columns
    held, free = ({r["id"] for r in x.collect()} for x in (unsure, sure))
    assert {i for i in range(20_000) if i % 100 == 3} <= held and len(held) < 300
    assert not held & free and len(held) + len(free) == unsure.count() + sure.count() == 20_000
    none = sifted(rows, sieve(keys.limit(0), "id", "k"), "id", "k")
    assert none[0].count() == 0 and none[1].count() == 20_000


def test_few_keys_are_joined_as_many_are(spark):
    """Keys that would fit a broadcast are shuffled with their rows all the same: what is written follows the rows."""
    rows = spark.range(2000).select("id", F.repeat(F.lit("text "), 50).alias("t"))
    keys = saved(rows.where("id % 10 = 3").select("id", F.lit(1).alias("lost")))
    unsure, _ = sifted(rows, sieve(keys, "id"), "id")
    for how in ("left", "inner", "left_semi"):
        plan = unsure.join(keys, "id", how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1, plan
    assert unsure.join(keys, "id").count() == 200


def test_keys_are_gathered_whole_or_in_pieces(spark):
    rng = random.Random(5)
    rows = [(k, i) for k in range(300) for i in rng.sample(range(-500, 500), rng.choice([1, 1, 2, 3, 9]))] + [(k, i) for k in (1000, 1001) for i in range(2500)]
    got = _gathered(spark.createDataFrame(rows, "key long, id long"), 100).collect()
    want = defaultdict(list)
    for k, i in rows:
        want[k].append(i)
    small = sorted(tuple(sorted(x)) for x in want.values() if 1 < len(x) <= 100)
    assert sorted(tuple(r["ids"]) for r in got if r["held"]) == small
    assert all(r["held"] == len(r["ids"]) and r["low"] == min(r["ids"]) for r in got if r["held"])
    assert len({(r["who"], r["held"], r["low"]) for r in got if r["held"]}) == len(set(small))
    large = [r for r in got if not r["held"]]
    assert {r["low"] for r in large} == {0}
    assert sorted(i for r in large for i in r["ids"] if i) == sorted([*range(1, 2500)] * 2)


def test_symbols_that_recur(spark):
    rng = random.Random(6)
    rows = [(d, i, rng.choice([rng.randint(0, 10**9), rng.randint(0, 900), 7])) for d in range(300) for i in range(60)]
    times = defaultdict(int)
    for r in rows:
        times[r[2]] += 1
    got = _recurring(spark.createDataFrame(rows, "doc long, idx int, s0 long")).collect()
    assert sorted(map(tuple, got)) == sorted(r for r in rows if times[r[2]] > 1)


def test_lists_of_tables_inside_one_another_are_told_apart(spark):
    with noting() as outer:
        with noting() as inner:
            saved(spark.range(1))
        saved(spark.range(2))
    assert len(inner) == 1 and len(outer) == 2


def test_texts_without_repeats_are_not_shuffled(spark):
    rng = random.Random(8)
    texts = [rng.randbytes(3000).hex() for _ in range(400)]
    texts[7] += texts[3][:900]
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()

    def written():
        bus.waitUntilEmpty()
        return sum(store.executorList(False).apply(k).totalShuffleWrite() for k in range(store.executorList(False).size()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = repeat_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        start = written()
        got = {r["doc_id"]: r["n_removed"] for r in report.collect()}
        moved = written() - start
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 400 and {k: n for k, n in got.items() if n} == {3: 900, 7: 900}
    assert moved < sum(map(len, texts)) / 5
