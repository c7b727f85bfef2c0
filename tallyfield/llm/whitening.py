"""Whitening of embeddings by a randomised range finder over all centred rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, release, saved

#: Whole entries are split here, so that sums of the two parts fit in 64 bits for 2**32 rows.
HALF = 31
LARGEST = 1 << 62


class Centre:
    """The mean of the fit list, kept as whole sums: ``n * y - S`` is exact for every row."""

    def __init__(self, n: int, sums: list[int], most: int):
        self.n, self.sums = n, sums
        #: whether n * y - S, and its squares' sum, stay within 64 bits
        self.short = 2 * n * (most + 1) < LARGEST
        self.short_squares = self.short and len(sums) * (2 * n * (most + 1)) ** 2 < LARGEST

    def scaled(self, y: np.ndarray) -> np.ndarray:
        if self.short:
            return y * self.n - np.array(self.sums, dtype=np.int64)
        return y.astype(object) * self.n - np.array(self.sums, dtype=object)

    def rows(self, y: np.ndarray) -> np.ndarray:
        return self.scaled(y).astype(np.float64) / self.n

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of the squares of n * y - S; None for those that don't fit in a long."""
        c = self.scaled(y)
        if self.short_squares:
            return (c * c).sum(axis=1).tolist()
        exact = (c.astype(object) ** 2).sum(axis=1)
        return [int(x) if x < 1 << 63 else None for x in exact]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def whole_vectors(df: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, y): floor(scale * entry) of the vectors that take part."""
    most = float(LARGEST // scale)
    rows = df.select(F.col(named(id_column)).cast("long").alias("vec_id"), F.col(named(vector)).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: F.coalesce(F.abs(x) < most, F.lit(False)))
    rows = rows.where(fine)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == (size["d"] if size else 0)).select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("y"))


def centre_of(fit: DataFrame) -> Centre:
    """Number and sums of the fit list; each task adds up its own rows."""

    def add(frames):
        n, most, high, low = 0, 0, 0, 0
        for f in frames:
            if not len(f):
                continue
            y = _matrix(f["y"])
            n, most = n + len(y), max(most, int(np.abs(y).max()))
            high, low = high + (y >> HALF).sum(axis=0), low + (y & ((1 << HALF) - 1)).sum(axis=0)
        if n:
            yield pd.DataFrame({"i": np.arange(len(high), dtype=np.int32), "n": n, "most": most, "high": high, "low": low})

    parts = fit.select("y").mapInPandas(add, "i int, n long, most long, high long, low long")
    held = parts.groupBy("i").agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect()
    return Centre(held[0]["n"] if held else 0, [(r["high"] << HALF) + r["low"] for r in held], max((r["most"] for r in held), default=0))


def product(fit: DataFrame, centre: Centre, right: np.ndarray) -> tuple[np.ndarray, float]:
    """Covariance times ``right``, and the covariance's trace, in one pass over all centred rows. Tasks
    add up their own rows; a row of the product is added over tasks, in their order."""
    width = right.shape[1]

    def add(frames):
        total = np.zeros((len(right), width + 1))
        for f in frames:
            if len(f):
                x = centre.rows(_matrix(f["y"]))
                total[:, :width] += x.T @ (x @ right)
                total[:, width] += (x * x).sum(axis=0)
        if total.any():
            yield pd.DataFrame({"i": np.arange(len(right), dtype=np.int32), "task": TaskContext.get().partitionId(), "row": [r.tobytes() for r in total]})

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(r) for r in f.sort_values("task")["row"]]
        return pd.DataFrame({"i": f["i"].iloc[:1], "row": [np.sum(rows, axis=0).tobytes()]})

    parts = fit.select("y").mapInPandas(add, "i int, task int, row binary").groupBy("i").applyInPandas(merge, "i int, row binary")
    out = np.zeros((len(right), width + 1))
    for i, row in parts.collect():
        out[i] = np.frombuffer(row)
    out /= max(centre.n, 1)
    return out[:, :width], float(out[:, width].sum())


def principal_axes(fit: DataFrame, centre: Centre, count: int, oversample: int, passes: int, tolerance: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues of the covariance, their unit vectors (columns) and its trace.

    A random basis of ``count + oversample`` vectors is multiplied by the covariance, pass by pass.
    After each pass Rayleigh-Ritz gives the best axes inside the basis, and what is left of the product
    beside them is their residual. If the residuals are still above ``tolerance`` of the largest eigenvalue
    after ``passes`` passes, the basis is filled up to all dimensions, where they vanish.
    """
    d = len(centre.sums)
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((d, min(d, count + oversample))))[0]
    for turn in range(passes + 1):
        image, trace = product(fit, centre, basis)
        small = basis.T @ image
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1], inner[:, ::-1]
        axes = basis @ inner
        left = np.sqrt(((image @ inner - axes * values) ** 2).sum(axis=0))[:count]
        if basis.shape[1] == d or values[0] <= 0 or left.max() <= tolerance * values[0]:
            break
        grown = image if turn < passes - 1 else np.hstack([image, rng.standard_normal((d, d - basis.shape[1]))])
        basis = np.linalg.qr(grown)[0]
    spread = values[:count] > max(values[0], 0) * 1e-12 * d
    values, axes = values[:count][spread], axes[:, :count][:, spread]
    # either sign would do; the same one every time is better
    lead = np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None, :], axis=0)
    return values, axes * np.where(lead < 0, -1.0, 1.0), trace


def whiten(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    components: int = 16,
    scale: int = 64,
    oversample: int = 8,
    passes: int = 4,
    tolerance: float = 1e-13,
) -> DataFrame:
    """Whitened vectors, a row for each vector and component: ``vec_id, component`` (from 1), ``n, deviation,
    whitened, explained, identity_error``.

    Entries become whole, floor(scale * entry); a constant that is added to all of them would change nothing
    here. The fit list has each distinct whole vector once: n, its mean, its covariance (divisor n) and the
    components' unit vectors come from it, whatever number of copies the rows hold. ``deviation`` is the
    exact sum of (n * entry - sum)**2, null where a long can't hold it. ``identity_error`` is measured by
    a last pass over the fit list.

    Vectors that are null or empty or hold null, non-finite or unbounded entries (2**62 / scale and
    beyond) take no part, nor do those of another length than most have (of equally frequent lengths the
    largest counts). Null ids stay null; repeated rows give rows each. Components without variance are left
    out, so equal vectors, a single one or an empty table give no rows. Other columns are ignored. The driver
    holds matrices of the vectors' length and the basis' width, never rows.
    """
    rows = saved(whole_vectors(df, id_column, vector, scale))
    fit = saved(rows.select("y").distinct())
    centre = centre_of(fit)
    values, axes, trace = np.zeros(0), np.zeros((len(centre.sums), 0)), 0.0
    if centre.n:
        values, axes, trace = principal_axes(fit, centre, components, oversample, passes, tolerance)
    white = axes / np.sqrt(values)
    error = 0.0
    if len(values):
        around, _ = product(fit, centre, white)
        error = float(np.abs(white.T @ around - np.eye(len(values))).max())
    release(fit)
    explained = [float(x) for x in values / trace] if len(values) else []

    @F.pandas_udf("deviation long, white array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for y in batches:
            if not len(y):
                yield pd.DataFrame({"deviation": pd.Series(dtype="Int64"), "white": []})
                continue
            whole = _matrix(y)
            yield pd.DataFrame({"deviation": pd.array(centre.deviations(whole), dtype="Int64"), "white": list(centre.rows(whole) @ white)})

    out = rows.withColumn("p", project.asNondeterministic()("y")).select("vec_id", "p.deviation", F.posexplode("p.white").alias("k", "whitened"))
    share = F.get(F.array(*[F.lit(x) for x in explained]).cast("array<double>"), F.col("k"))
    return out.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
