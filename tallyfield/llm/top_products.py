"""Exact k best inner products by elimination with a table of distances to pivots."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, window_top


def _finite(vector: str, scale: float):
    whole = lambda x: F.abs(x.cast("double") * scale)
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(whole(x)) & (whole(x) < float("inf"))), F.lit(False))


def _matrix(vectors, scale: float) -> np.ndarray:
    """floor(scale * x) as rows of whole numbers; shorter vectors end in zeros. Doubles hold
    them exactly while every product sum stays below 2**53, Python integers otherwise."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(np.asarray(v, dtype=np.float64) * scale)
    if width and np.abs(out).max() ** 2 * width >= 2.0**53:
        return _unbounded(out)
    return out


def _unbounded(x: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    out = np.empty(x.shape, dtype=object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def _pad(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.concatenate([x, np.zeros((len(x), width - x.shape[1]), dtype=x.dtype)], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(np.float64), pivots.astype(np.float64)
    width = max(x.shape[1], p.shape[1])
    x, p = _pad(x, width), _pad(p, width)
    most = max(np.abs(x).max(initial=0), np.abs(p).max(initial=0))
    if most > 1e150:  # squares would overflow; cutting distances off at the largest double brings none apart
        x, p = x / most, p / most
        with np.errstate(over="ignore"):
            return np.minimum(most * np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T, 0)), np.finfo(np.float64).max)
    square = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(square, 0))


def _best_in_block(q: np.ndarray, qid, qpiv, floor, c: np.ndarray, cid, cpiv, k: int):
    """For each query its k best of the block at least as good as ``floor``: candidates are
    evaluated in the order of their upper bounds until the next bound is below the k-th score.

    Bound: (|q|^2 + |c|^2 - d^2) / 2 with d the largest |d(q, p) - d(c, p)| over the pivots p.
    """
    width = max(q.shape[1], c.shape[1])
    q, c = _pad(q, width), _pad(c, width)
    if q.dtype == object or c.dtype == object:
        q, c = _unbounded(q), _unbounded(c)
    q2, c2 = _norms(q), _norms(c)
    low = np.zeros((len(q), len(c)))
    for p in range(qpiv.shape[1]):
        np.maximum(low, np.abs(qpiv[:, p, None] - cpiv[None, :, p]), out=low)
    bound = _upper(q2[:, None], c2[None, :], low)
    order = np.argsort(-bound, axis=1, kind="stable")
    rows = []
    for i in range(len(q)):
        best_s, best_id, at, step = np.empty(0, dtype=q.dtype), np.empty(0, dtype=np.int64), 0, 64
        kth = floor[i]
        while at < len(c):
            take = order[i, at : at + step]
            take = take[bound[i, take] >= kth]
            if not len(take):
                break
            at, step = at + step, 4 * step
            s, ids = c[take] @ q[i], cid[take]
            keep = ids != qid[i]
            best_s, best_id = np.concatenate([best_s, s[keep]]), np.concatenate([best_id, ids[keep]])
            top = np.lexsort((best_id, -best_s))[:k]
            best_s, best_id = best_s[top], best_id[top]
            if len(best_s) == k:
                kth = max(kth, _at_most(best_s[-1]))
        rows += [(qid[i], int(v), s) for v, s in zip(best_id, best_s)]
    out = pd.DataFrame([x[:2] for x in rows], columns=["query_id", "vec_id"])
    # scores beyond long are told apart by their exact values, in order; what is returned is the nearest long
    exact = [int(s) for _, _, s in rows]
    out["score"] = np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact], dtype=np.int64)
    out["order"] = [_ordered(s) for s in exact]
    return out[["query_id", "vec_id", "score", "order"]].astype({"query_id": "int64", "vec_id": "int64"})


def _norms(x: np.ndarray) -> np.ndarray:
    """Squared lengths; infinite where doubles can't hold them, which only makes a bound useless."""
    with np.errstate(over="ignore"):
        return (x.astype(np.float64) ** 2).sum(1)


def _at_most(score) -> float:
    """A double no larger than the score."""
    try:
        return float(score)
    except OverflowError:
        return np.finfo(np.float64).max if score > 0 else -np.inf


def _upper(q2, c2, low):
    """The bound with room for the rounding of doubles; infinite where it isn't known."""
    with np.errstate(over="ignore", invalid="ignore"):
        bound = (q2 + c2 - low * low) / 2
        bound = bound + 1e-6 * (1 + np.abs(bound)) + 1e-9 * (q2 + c2)
    return np.where(np.isnan(bound), np.inf, bound)


def _ordered(s: int) -> bytes | None:
    """Bytes that sort as whole numbers do, for those beyond long (others: none); products of finite
    floats, scaled, have less than 400 bytes."""
    if -(1 << 63) <= s < 1 << 63:
        return None
    return (s + (1 << 3199)).to_bytes(400, "big")


def top_inner_products(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    query_divisor: int = 50,
    scale: float = 256.0,
    pivots: int = 24,
    block_rows: int = 2048,
    query_rows: int = 512,
    table_blocks: int = 4096,
    seed: int = 11,
) -> DataFrame:
    """For every query (id divisible by ``query_divisor``) its ``k`` highest inner products
    among all other rows, exact, ties to the smaller id: ``query_id, rank, vec_id, score``.

    Components are floor(scale * x). Pivots are a bounded sample of rows; each row carries its
    distances to them. Rows go to blocks by nearest pivot. A query meets first the block of
    its own pivot. The k-th score found there lets whole blocks go whose best bound, from the
    blocks' ranges of pivot distances, is lower: packs of ``query_rows`` queries, with their distances
    alone, meet the ranges of ``table_blocks`` blocks at a time as one matrix, and only pairs of a query and a
    block that may still give a better row go on. Rows inside blocks go likewise.

    Vectors that are null or hold null or non-finite components, or doubles that aren't finite once scaled, take no part; an empty vector
    scores 0 with all; shorter vectors count as ending in zeros. Scores beyond long are ranked by their
    exact values and returned as the nearest long. Of rows with the same id the one with the least
    vector counts; null ids take no part. An empty table gives no rows; other columns are ignored.
    """
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v")).where("vec_id is not null").where(_finite("v", scale))
    rows = saved(rows.groupBy("vec_id").agg(F.min("v").alias("v")))
    total = rows.count()
    empty = "query_id long, rank int, vec_id long, score long"
    if not total:
        return df.sparkSession.createDataFrame([], empty)
    chosen = _matrix(list(rows.orderBy(F.xxhash64(F.lit(seed), "vec_id")).limit(pivots).toPandas()["v"]), scale)

    def locate(frames):
        for f in frames:
            if len(f):
                x = _matrix(list(f["v"]), scale)
                d = _distances(x, chosen)
                yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy(), "v": f["v"].to_numpy(), "cell": d.argmin(1).astype("int32"), "d": list(d), "n": _norms(x)})

    item = "vec_id long, v array<double>, cell int, d array<double>, n double"
    placed = saved(rows.select("vec_id", F.col("v").cast("array<double>").alias("v")).mapInPandas(locate, item))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec_id"), "parts")))
    is_query = F.pmod("vec_id", F.lit(query_divisor)) == 0

    # what a block's bound needs: ranges of the pivot distances and the largest squared length
    ranges = (
        placed.select("block", "n", F.posexplode("d").alias("p", "x"))
        .groupBy("block", "p")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.max("n").alias("n"))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("p", "lo", "hi"))).alias("ranges"), F.max("n").alias("n"))
    )
    blocks = saved(placed.groupBy("block").agg(F.collect_list(F.struct("vec_id", "v", "d")).alias("rows")).join(ranges, "block"))
    query_parts = max(1, -(-total // (query_divisor * query_rows)))
    block_parts = max(1, -(-total // (block_rows * table_blocks)))

    def meet(frames):
        for f in frames:
            for qs, cs in zip(f["queries"], f["rows"]):
                q, c = _matrix([r["v"] for r in qs], scale), _matrix([r["v"] for r in cs], scale)
                yield _best_in_block(
                    q, np.array([r["vec_id"] for r in qs]), np.stack([r["d"] for r in qs]), np.array([r["floor"] for r in qs]),
                    c, np.array([r["vec_id"] for r in cs]), np.stack([r["d"] for r in cs]), k,
                )

    result = "query_id long, vec_id long, score long, order binary"
    start = (
        placed.where(is_query)
        .withColumn("floor", F.lit(float("-inf")))
        .groupBy("block", F.pmod(F.xxhash64("vec_id"), F.lit(query_parts)).alias("part"))
        .agg(F.collect_list(F.struct("vec_id", "v", "d", "floor")).alias("queries"))
    )
    first = saved(start.join(blocks, "block").select("queries", "rows").mapInPandas(meet, result))
    kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("floor"))
    queries = placed.where(is_query).join(kth, placed["vec_id"] == kth["query_id"], "left").select("vec_id", "v", "d", "n", "block", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    queries = saved(queries)

    # packs of queries, without their vectors, against the ranges of many blocks: the ids of the pairs that remain
    packs = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(query_parts)).alias("part")).agg(F.collect_list(F.struct("vec_id", "d", "n", "floor", "block")).alias("queries"))
    tables = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(block_parts)).alias("table")).agg(F.collect_list(F.struct("block", "ranges", "n")).alias("blocks"))
    spread = packs.withColumn("table", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(block_parts - 1).cast("long"))))

    def remain(frames):
        for f in frames:
            for qs, bs in zip(f["queries"], f["blocks"]):
                name = np.array([b["block"] for b in bs], dtype=object)
                lo, hi = (np.array([[r[e] for r in b["ranges"]] for b in bs]) for e in ("lo", "hi"))
                n = np.array([b["n"] for b in bs])
                for q in qs:
                    gap = np.maximum(lo - q["d"], q["d"] - hi).max(axis=1).clip(0)
                    some = name[(_upper(q["n"], n, gap) >= q["floor"]) & (name != q["block"])]
                    if len(some):
                        yield pd.DataFrame({"vec_id": q["vec_id"], "block": some})

    pairs = spread.join(tables, "table").select("queries", "blocks").mapInPandas(remain, "vec_id long, block string")
    open_queries = (
        saved(pairs)
        .join(queries.drop("block"), "vec_id")
        .groupBy("block", F.pmod(F.xxhash64("vec_id"), F.lit(query_parts)).alias("part"))
        .agg(F.collect_list(F.struct("vec_id", "v", "d", "floor")).alias("queries"))
    )
    rest = open_queries.join(blocks, "block").select("queries", "rows").mapInPandas(meet, result)
    both = first.union(rest)
    best = window_top(both, ["query_id"], [F.desc("score"), F.when(F.col("score") > 0, F.col("order")).desc_nulls_last(), F.col("order").desc_nulls_first(), F.asc("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
