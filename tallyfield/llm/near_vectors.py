"""Near-duplicate embeddings by a forest of random-projection trees with spill."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, local_components, per_key, saved


def unit_rows(vectors) -> np.ndarray:
    """The vectors as rows of length 1, in double precision."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(vector: str):
    """True for vectors that are not null, have components, none null or non-finite, not all zero."""
    c = F.col(vector)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(c) > 0) & fine & F.exists(c, lambda x: x != 0), F.lit(False))


class Forest:
    """Trees that split at the median of a random projection, each of their levels with its own
    direction. Rows whose projection lies within ``spill`` (as a share of rows) of the median
    go to both halves, so close vectors rarely part.

    Fitted on a bounded sample: only the thresholds come from it; every row is routed.
    """

    def __init__(self, sample: np.ndarray, trees: int, depth: int, spill: float, seed: int):
        rng = np.random.default_rng(seed)
        self.depth, self.trees = depth, trees
        self.directions = rng.standard_normal((trees, max(depth, 1), sample.shape[1]))
        self.bounds = np.zeros((trees, 1 << depth, 2))
        for t in range(trees):
            nodes = {1: np.arange(len(sample))}
            for level in range(depth):
                below = {}
                for node, rows in nodes.items():
                    p = sample[rows] @ self.directions[t, level]
                    low, high = np.quantile(p, [0.5 - spill, 0.5 + spill]) if len(p) else (0.0, 0.0)
                    self.bounds[t, node] = low, high
                    below[2 * node], below[2 * node + 1] = rows[p <= high], rows[p >= low]
                nodes = below

    def leaves(self, x: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf of the tree that a row reaches."""
        row, node = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
        for level in range(self.depth):
            p = (x @ self.directions[tree, level])[row]
            low, high = self.bounds[tree, node].T
            left, right = p <= high, p >= low
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        return row, node


CELL = ["tree", "cell", "label"]
#: Further levels of a tree after which a cell that is still too large is compared in blocks.
ROUNDS = 24


def _projection(seed: int, level: int):
    """Projections of vectors on the direction that each tree has at this level."""

    @F.pandas_udf("double")
    def projected(tree: pd.Series, x: pd.Series) -> pd.Series:
        m = np.stack([np.frombuffer(b) for b in x])
        out = np.zeros(len(m))
        for t in np.unique(tree):
            at = (tree == t).to_numpy()
            out[at] = m[at] @ np.random.default_rng((seed, int(t), level)).standard_normal(m.shape[1])
        return pd.Series(out)

    return projected


def _refined(rows: DataFrame, most: int, spill: float, seed: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Goes on splitting the cells (of one label) with more than ``most`` rows, a level a round, at the quantiles of
    each cell's own projections, which Spark computes: ``(tables of cells that are small enough, the rest)``."""
    done, level = [], 0
    while True:
        large = rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > most).drop("held")
        large = saved(large)
        done.append(rows.join(large, CELL, "left_anti"))
        if large.isEmpty():
            return done, None
        if level == ROUNDS:
            return done, rows.join(large, CELL, "left_semi")

        big = saved(rows.join(large, CELL, "left_semi").withColumn("p", _projection(seed, level)("tree", "x")))
        bounds = big.groupBy(*CELL).agg(F.percentile_approx("p", [0.5 - spill, 0.5 + spill], 1000).alias("b"))
        sides = F.array(F.when(F.col("p") <= F.col("b")[1], 0), F.when(F.col("p") >= F.col("b")[0], 1))
        split = big.join(saved(bounds), CELL).withColumn("side", F.explode(sides)).where("side is not null")
        rows = saved(split.select("tree", F.xxhash64("cell", "side").alias("cell"), "label", "rep", "x"))
        level += 1


def link_near_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    trees: int = 8,
    leaf_rows: int = 2000,
    group_rows: int = 3000,
    spill: float = 0.06,
    sample_rows: int = 8192,
    block_rows: int = 1024,
    seed: int = 7,
) -> DataFrame:
    """Links vectors of the same non-null label whose cosine is ``threshold`` or more.

    Returns one row per id: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Exact copies count as one vector with a weight. The others are routed down every tree of a
    forest fitted on ``sample_rows`` vectors, with cells of some ``group_rows``; where a label has more
    than ``leaf_rows`` in a cell, the cell is split on by its own quantiles, a level a round, so a
    task never holds more than a leaf whatever the size of the table. Vectors that no
    projection parts are compared in blocks. Within each leaf all vectors of a label are compared,
    and the verified links of all trees are united into components. Links are then counted
    exactly inside each component, in pairs of blocks, each of which is a task's work: that is
    the square of a component's size, so a component of millions is costly though nothing of it
    is ever in one place. A count misses a link only where the forest left a component in two.

    Vectors that are null, empty, all zero or hold null or non-finite components, and rows
    with a null label, link with nothing. Vectors of different lengths are never compared.
    Of rows with the same id the one with the least (label, vector) counts. Rows with a null
    id are left out. An empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    rows = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v")
    rows = saved(rows.withColumn("ok", usable("v") & F.col("label").isNotNull()))
    classes = saved(rows.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")))

    dims = [r[0] for r in classes.select(F.size("v").alias("d")).distinct().limit(1025).collect()]
    if len(dims) > 1024:
        raise ValueError("more than 1024 different vector lengths")
    edges = None
    for d in sorted(dims):
        part = classes.where(F.size("v") == d)
        total = part.count()
        fit = part.orderBy(F.xxhash64("rep")).limit(sample_rows).select("v").toPandas()["v"]
        depth = max(0, min(math.ceil(math.log2(max(1, total / group_rows))), int(math.log2(max(1, len(fit) / 32)))))
        forest = Forest(unit_rows(fit), trees, depth, spill, seed)

        def route(frames, forest=forest):
            for f in frames:
                if len(f):
                    x = unit_rows(f["v"])
                    raw = np.array([r.tobytes() for r in x], dtype=object)
                    for t in range(forest.trees):
                        row, leaf = forest.leaves(x, t)
                        yield pd.DataFrame({"tree": t, "cell": leaf, "label": f["label"].to_numpy()[row], "rep": f["rep"].to_numpy()[row], "x": raw[row]})

        routed = saved(part.mapInPandas(route, "tree int, cell long, label string, rep long, x binary"))
        small, dense = _refined(routed, leaf_rows, spill, seed + d)
        found = [_compared(rows, CELL, threshold) for rows in small]
        if dense is not None:
            sizes = dense.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / (leaf_rows // 2)).cast("int").alias("blocks"))
            own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
            pairs = dense.join(saved(sizes), CELL).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pairs = pairs.select(*CELL, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "rep", "x")
            found.append(_compared(pairs, [*CELL, "low", "high"], threshold))
        for more in found:
            edges = more if edges is None else edges.union(more)

    if edges is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    comp = saved(components(edges))
    counted = _count_links(classes, comp, threshold, block_rows)
    of_class = (
        classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counted, "rep", "left")
        .select("label", "v", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    )
    return rows.join(of_class.withColumn("ok", F.lit(True)), ["ok", "label", "v"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def _compared(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """(a, b) that join the rows of each key whose cosine is ``threshold`` or more."""

    def compare(frames):
        for f in per_key(frames, keys):
            x, rep = np.stack([np.frombuffer(b) for b in f["x"]]), f["rep"].to_numpy()
            i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
            low = local_components(len(rep), i, j)
            linked = np.flatnonzero(low != np.arange(len(rep)))
            yield pd.DataFrame({"a": rep[linked], "b": rep[low[linked]]})

    return rows.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInPandas(compare, "a long, b long")


def _count_links(classes: DataFrame, comp: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """(rep, links): the weight of the other classes that a class links with, from comparing
    every two blocks of each component. Small components share a group."""
    sizes = comp.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    members = comp.join(sizes, "component").join(classes, comp["node"] == classes["rep"])
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs = (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .select("component", "low", "high", "own", "rep", "weight", "v")
    )

    def count(frames):
        for f in per_key(frames, ["component", "low", "high"]):
            x, own, w = unit_rows(f["v"]), f["own"].to_numpy(), f["weight"].to_numpy()
            low, high = f["low"].iloc[0], f["high"].iloc[0]
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if low != high:
                near &= own[:, None] != own[None, :]
            yield pd.DataFrame({"rep": f["rep"].to_numpy(), "links": near @ w})

    spread = pairs.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "rep")
    return spread.mapInPandas(count, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
