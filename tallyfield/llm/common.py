"""Helpers that several operators share: scratch tables, byte hashing, connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# ------------------------------------------------------------------ scratch tables


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only where none is set and
    everything runs on one machine."""
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tallyfield-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


#: Whether shuffle files go when the query that wrote them ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read again: later steps neither
    recompute them nor depend on an executor that still holds them. Nothing reads the shuffle files
    of the write again, so they go with its end; the session's own setting holds for all else."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    for noted in _noted:
        noted.append(out)
    return out


#: Lists that note the tables that ``saved`` writes, while they are here.
_noted: list[list[DataFrame]] = []


@contextmanager
def noting():
    """The tables that ``saved`` writes inside, as a list that grows."""
    tables: list[DataFrame] = []
    _noted.append(tables)
    try:
        yield tables
    finally:
        _noted[:] = [t for t in _noted if t is not tables]


def release(*tables: DataFrame) -> None:
    """Removes tables that ``saved`` wrote and that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def named(column: str) -> str:
    """A column's name as Spark's functions take it, dots included."""
    return "`" + column.replace("`", "``") + "`"


def fresh(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of the table has."""
    held = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in held:
        name += "_"
    return name


# ------------------------------------------------------------------ rows that a join can't touch

#: Places of a sieve, of which 64 travel in a row: what is broadcast stays this small for any number of keys.
SIEVE = 1 << 25


def _place(columns):
    return F.pmod(F.xxhash64(*columns), F.lit(SIEVE))


def sieve(keys: DataFrame, *columns: str) -> DataFrame:
    """(word, bits): the places that the hashes of the keys fall on."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    places = keys.select(_place(columns).alias("place"))
    return saved(places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")))


def sifted(rows: DataFrame, seen: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of the sieve's keys, and those that have none of them. An exact join has to
    follow for the former; the latter, long texts above all, need no shuffle for it. The join shuffles these rows
    whatever the keys' size: what it writes is in proportion to them, without a step where keys get too many to broadcast."""
    word, bits = fresh(rows, "word"), fresh(rows, "bits")
    held = rows.withColumn(word, F.shiftright(_place(columns), 6))
    held = held.join(F.broadcast(seen.toDF(word, bits)), word, "left")
    at = _place(columns).bitwiseAND(F.lit(63)).cast("int")
    hit = F.coalesce(F.call_function("shiftright", F.col(bits), at).bitwiseAND(F.lit(1)), F.lit(0)) == 1
    return held.where(hit).drop(word, bits).hint("merge"), held.where(~hit).drop(word, bits)


# ------------------------------------------------------------------ hashing of bytes

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.array([_BASE], dtype=np.uint64)
_BACK = np.array([pow(_BASE, -1, 1 << 64)], dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    """Powers of the hash base, and of its inverse modulo 2**64, for n positions."""
    global _powers, _inverse
    if len(_powers) < n:
        m = max(n, 2 * len(_powers), 1 << 16)
        for name, step in (("_powers", _STEP), ("_inverse", _BACK)):
            factors = np.full(m, step[0], dtype=np.uint64)
            factors[0] = 1
            globals()[name] = np.multiply.accumulate(factors)


def mix64(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


#: Two independent values for each byte.
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)


def prefix_hashes(raw: np.ndarray, family: int = 0) -> np.ndarray:
    """P with P[j] - P[i] = sum of value(byte) * base**position over positions i..j-1."""
    _grow(len(raw) + 1)
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[family][raw] * _powers[: len(raw)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every byte span [start, end), equal for equal bytes wherever they are."""
    h = (prefix[end] - prefix[start]) * _inverse[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def scattered_grams(prefix: np.ndarray, size: int) -> np.ndarray:
    """A quick hash of every gram of ``size`` bytes, good for picking among neighbours."""
    n = len(prefix) - size
    h = (prefix[size:] - prefix[:n]) * _inverse[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, maximal runs without the bytes 0x20 and 0x09-0x0D."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text in their order, A-Z lower-cased."""
    raw = np.frombuffer((text or b"").lower(), dtype=np.uint8)
    start, end = word_spans(raw)
    return span_hashes(prefix_hashes(raw), start, end) if len(start) else np.empty(0, dtype=np.uint64)


def shingle_hashes(h: np.ndarray, words: int) -> np.ndarray:
    """64-bit hashes of the shingles of a text's words, in their order and as often as they come.

    A text of fewer words has its whole sequence as one shingle; a text without
    words has none.
    """
    if not len(h):
        return h
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9FB21C651E98DF25) + h[k : k + n])
    return out


def distinct(s: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    s = np.sort(s)
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The different ``shingle_hashes`` of a text, sorted."""
    return distinct(shingle_hashes(word_hashes(text), words))


def words_by_text(texts, most_bytes: int = 1 << 16):
    """The ``word_hashes`` of a few texts at a time, one after the other, and where each text's words begin and the last one's end.
    Many short texts cost no more calls than a long one."""
    texts = [t or b"" for t in texts]
    size = np.cumsum([len(t) for t in texts]) // most_bytes
    cut = np.flatnonzero(np.diff(size)) + 1
    for a, b in zip([0, *cut], [*cut, len(texts)]):
        raw = np.frombuffer(b" ".join(texts[a:b]).lower(), dtype=np.uint8)
        start, end = word_spans(raw)
        h = span_hashes(prefix_hashes(raw), start, end) if len(start) else np.empty(0, dtype=np.uint64)
        yield h, np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts[a:b])]))


# ------------------------------------------------------------------ groups of rows


def slices(frames, column: str, most_bytes: int = 4 << 20):
    """The batches again, cut so that the texts of a piece have few bytes: what a step derives
    from them stays small. A single longer text is a piece of its own."""
    for frame in frames:
        if not len(frame):
            continue
        size = np.cumsum([len(t) if t is not None else 0 for t in frame[column]]) // most_bytes
        cut = np.flatnonzero(np.diff(size)) + 1
        for a, b in zip([0, *cut], [*cut, len(frame)]):
            yield frame.iloc[a:b].reset_index(drop=True)


def per_key(frames, keys):
    """Whole groups from batches that come sorted by keys; a group may span batches."""
    import pandas as pd

    rest = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        change = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(change)
        for a, b in zip(starts[:-1], starts[1:]):
            yield frame.iloc[a:b]
        rest = frame.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def local_components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and undirected links, the smallest node of each node's component."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
    return label


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a long, b long): rows (node, component), component being the
    smallest node reachable. Nodes without links to others don't appear; nulls are no nodes.

    Alternates the two star rewritings: every node's larger neighbours move to its smallest
    neighbour, then its smaller ones do. Each round writes its edges to the shared folder.
    A hub's edges are only joined, never gathered in one row or task.
    """
    e, seen = saved(_links(edges)), None
    while True:
        both = e.union(e.select(F.col("v"), F.col("u"))).toDF("x", "y")
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("p"))
            .select(F.col("p.u").alias("u"), F.col("p.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        last, e = e, saved(small)
        release(last)
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state


def _links(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def hashed_fold(id_column: str, parts: int):
    """crc32 of the id written as text, modulo parts (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(parts))


def window_top(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of every key; Spark cuts each task's rows to n before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
