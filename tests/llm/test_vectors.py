"""Near-duplicate vectors and exact top inner products against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import near_vectors, top_products

from .helpers import reachable, table

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label string, rep long, cell int, v string, x double, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2, "v", 0.5, 3) for i, v, l in rows], SCHEMA)


def edge_vectors():
    rng = np.random.default_rng(6)
    rows = [
        (1, None, "a"), (2, [], "a"), (3, [0.0] * 4, "a"), (4, [1.0, NAN, 0.0, 0.0], "a"), (5, [1.0, INF, 0.0, 0.0], "a"),
        (6, [1.0, None, 0.0, 0.0], "a"), (7, [1.0, 0.0, 0.0, 0.0], "a"), (8, [2.0, 0.0, 0.0, 0.0], "a"), (9, [1.0, 0.0, 0.0, 0.0], "b"),
        (10, [1.0, 0.0, 0.0, 0.0], None), (50, [1.0, 0.0, 0.0, 0.0], "a"), (100, [1.0, 0.0], "a"), (0, [0.5, 0.5, 0.0, 0.0], "b"),
        (-50, [3e38, 1.0, 0.0, 0.0], "a"), (None, [1.0, 0.0, 0.0, 0.0], "a"),
    ]
    for k in range(150, 400):
        base = rng.standard_normal(4)
        rows.append((k, [float(x) for x in np.float32(base)], "ab"[k % 2]))
    return rows


# ------------------------------------------------------------------ near duplicates


def brute_links(rows, threshold=0.93):
    fine = [(i, np.asarray(v, dtype=np.float64), l) for i, v, l in rows if i is not None and l is not None and v and None not in v]
    fine = [(i, v, l) for i, v, l in fine if np.isfinite(v).all() and (v != 0).any()]
    ids = [i for i, _, _ in rows if i is not None]
    count, links = dict.fromkeys(ids, 0), []
    groups = {}
    for i, v, l in fine:
        groups.setdefault((l, len(v)), []).append((i, v / np.abs(v).max()))
    for held in groups.values():
        x = np.stack([v / np.sqrt(v @ v) for _, v in held])
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            links.append((held[a][0], held[b][0]))
            count[held[a][0]] += 1
            count[held[b][0]] += 1
    low = reachable(ids, links)
    return sorted((i, count[i], low[i], low[i] == i) for i in ids), links


def got_links(df, **kw):
    return sorted(tuple(r) for r in near_vectors.link_near_vectors(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect())


@pytest.mark.parametrize("limits", [{}, {"group_rows": 40, "leaf_rows": 40, "trees": 30, "spill": 0.12, "block_rows": 16}])
def test_near_vectors_edges(spark, limits):
    rows = edge_vectors()
    want, _ = brute_links(rows)
    assert got_links(frame(spark, rows), **limits) == want


def test_near_vectors_empty_and_none_usable(spark):
    assert got_links(frame(spark, [])) == []
    assert got_links(frame(spark, [(1, None, "a"), (2, [0.0], "a")])) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("limits", [{}, {"group_rows": 200, "leaf_rows": 60}, {"group_rows": 4000, "leaf_rows": 40}])
def test_near_vectors_recall(spark, limits):
    """Links planted among the table's vectors, at several depths: of all links, those whose ends share a
    component; counts inside components are exact."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], None if r["label"] is None else str(r["label"])) for r in df.select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(9)
    width, labels = len(rows[0][1]), sorted({l for _, _, l in rows if l is not None})[:2]
    for k in range(1200):
        base = rng.standard_normal(width)
        for c in range(2 if k % 4 else 1):
            noise = rng.standard_normal(width) * rng.uniform(0.1, 0.25)
            rows.append((10**6 + 2 * k + c, [float(v) for v in np.float32(base + c * noise)], labels[k % 2]))
    # a tight group of a third of all rows, of which no two are equal
    base = rng.standard_normal(width)
    rows += [(2 * 10**6 + k, [float(v) for v in np.float32(base + 0.05 * rng.standard_normal(width))], labels[0]) for k in range(len(rows) // 2)]
    want, links = brute_links(rows)
    got = {i: (n, c) for i, n, c, _ in got_links(frame(spark, rows), **limits)}
    loose = [x for x in links if x[1] < 2 * 10**6]
    assert len(loose) > 800
    assert sum(got[a][1] == got[b][1] for a, b in loose) >= 0.98 * len(loose)
    assert sum(got[a][1] == got[b][1] for a, b in links) >= 0.98 * len(links)
    assert all(got[i][0] <= n for i, n, _, _ in want)


def test_near_vectors_that_no_projection_parts(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "ROUNDS", 1)
    rng = np.random.default_rng(3)
    rows = [(k, [float(v) for v in np.float32([1, 1, 1, 1] + 0.01 * rng.standard_normal(4))], "a") for k in range(300)]
    assert got_links(frame(spark, rows), leaf_rows=20) == brute_links(rows)[0]


# ------------------------------------------------------------------ top inner products


def brute_top(rows, k=5, divisor=50):
    held = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(np.asarray(v, dtype=float)).all():
            held[i] = [int(np.floor(256 * float(x))) for x in v]
    out = []
    for q in held:
        if q % divisor == 0:
            scores = sorted((-sum(a * b for a, b in zip(held[q], c)), i) for i, c in held.items() if i != q)
            out += [(q, r + 1, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got_top(df, **kw):
    return sorted(tuple(r) for r in top_products.top_inner_products(df, **kw).select("query_id", "rank", "vec_id", "score").collect())


def test_top_products_edges(spark):
    rows = edge_vectors() + [(-100, [-3e38, 2.0, 0.0, 0.0], "a"), (7001, [2e38, 0.0, 0.0, 0.0], "a"), (7002, [-2e38, 0.0, 0.0, 0.0], "a"), (7003, [2.5e38, 0.0, 0.0, 0.0], "a")]
    ties = [(1000 + k, [1.0, 0.0, 0.0, 0.0], None) for k in range(9)]
    rows += ties
    want = brute_top([(i, v) for i, v, _ in rows])
    assert got_top(frame(spark, rows)) == want
    assert got_top(frame(spark, rows), block_rows=16, query_rows=2, pivots=3, table_blocks=3) == want
    assert got_top(frame(spark, [])) == []
    assert got_top(frame(spark, [(50, [1.0, 2.0], "a")])) == []
    assert got_top(frame(spark, [(50, [1.0], "a"), (1, [2.0], "a")])) == [(50, 1, 1, 131072)]


def test_top_products_of_doubles_beyond_all_bounds(spark):
    rows = [(0, [1e200, 1.0]), (1, [-1e200, 2.0]), (2, [1e200, -3.0]), (50, [2e305, 1e305]), (3, [0.5, 0.5]), (4, [2e199, 7.0])]
    df = spark.createDataFrame([*rows, (7, [1e308, 0.0])], "vec_id long, embedding array<double>")
    assert got_top(df, k=3) == brute_top(rows, 3)


def test_top_products_table(spark):
    df = table(spark, "embeddings")
    want = brute_top([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert got_top(df.withColumn("query_id", F.lit(1))) == want
