"""Packing token sequences into as few fixed-length sequences as possible."""

from __future__ import annotations

import base64
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """The byte-level BPE in the file (a ``.json`` of the tokenizers library, whose vocabulary and
    pattern the rank file beside it repeats): text -> ids, special strings as their ids."""
    import public_tokenizers
    import tiktoken

    ranks_path = path[: -len(".json")] + ".tiktoken" if path.endswith(".json") else path
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def token_ids(tokenizer, text: str | None) -> np.ndarray:
    return np.asarray(tokenizer.encode(text or "", allowed_special="all"), dtype=np.uint32)


def pieces(df: DataFrame, id_column: str, text: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, bucket): the documents' ids with their end, in
    pieces of ``capacity`` of which only the first may be shorter."""

    def cut(frames):
        encode = byte_bpe(tokenizer)
        for f in slices(frames, "t"):
            rows = []
            for doc, t in zip(f["id"], f["t"]):
                ids = np.append(token_ids(encode, t), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                marks = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(marks[:-1], marks[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


class Sums:
    """The lengths in stock, and an index of the sums of two and three of them.

    For each sum the index has the larger members of its pairs, and the largest of its triples, from the largest
    down; the rest of a triple is a pair in the index of what is left. Stock only falls, so what is used up
    in front of a list stays so: its mark moves on and never back.
    """

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).tolist()
        there = np.asarray(counts) > 0
        self.pairs, self.pair_at = [np.empty(0, dtype=np.int64)], [0] * (capacity + 1)
        for total in range(1, capacity + 1):
            larger = np.arange(total - 1, (total + 1) // 2 - 1, -1)
            self.pairs.append(larger[there[larger] & there[total - larger]])
        self.falling = np.flatnonzero(there)[::-1]  # the largest members of triples
        self.triple_at = [0] * (capacity + 1)

    def lasting(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths are in stock together."""
        if len(set(lengths)) == len(lengths):
            return min(map(self.left.__getitem__, lengths))
        return min(self.left[l] // n for l, n in Counter(lengths).items())

    def use(self, lengths: tuple[int, ...], times: int) -> None:
        for l in lengths:
            self.left[l] -= times

    def pair(self, total: int, beside: tuple[int, ...], most: int | None = None) -> tuple[int, int] | None:
        """The pair of the sum with the largest member (``most`` at most) that is in stock beside other lengths."""
        held, at = self.pairs[total], self.pair_at[total]
        while at < len(held) and not (self.left[held[at]] and self.left[total - held[at]]):
            at += 1
        self.pair_at[total] = at
        if most is not None:
            at = max(at, int(np.searchsorted(-held, -most)))
        for a in held[at:].tolist():
            if self.left[a] and self.left[total - a] and self.lasting((*beside, a, total - a)):
                return a, total - a
        return None

    def triple(self, total: int, beside: tuple[int, ...]) -> tuple[int, int, int] | None:
        """The triple of the sum with the largest members that is in stock beside other lengths."""
        held, at = self.falling, self.triple_at[total]
        while at < len(held) and (held[at] > total - 2 or not self.left[held[at]]):
            at += 1
        self.triple_at[total] = at
        for a in held[at:].tolist():
            if 3 * a < total:
                break
            if self.left[a] and (rest := self.pair(total - a, (*beside, a), a)):
                return a, *rest
        return None

    def filling(self, gap: int, beside: tuple[int, ...], most: int = 3) -> tuple[int, ...] | None:
        """At most ``most`` lengths in stock with exactly this sum, as few as can be."""
        if gap <= 0:
            return None
        if self.lasting((*beside, gap)):
            return (gap,)
        return self.pair(gap, beside) or (self.triple(gap, beside) if most > 2 else None)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Which lengths go together: (how many sequences, their lengths), for ``counts[l]`` pieces of
    length l. Works on the histogram alone, so its cost doesn't grow with the corpus.

    From the longest length down, each fills its gap exactly: by one length, by a pair, by a triple of the index
    of sums, as often as all of them last. What no combination fills goes best-fit: the longest length that
    fits, again and again, with one or two lengths that fill the rest exactly where there are any.
    """
    stock, out = Sums(counts, capacity), []

    def use(lengths: tuple[int, ...]) -> None:
        times = stock.lasting(lengths)
        stock.use(lengths, times)
        out.append((times, lengths))

    for head in range(capacity, 0, -1):
        while stock.left[head] > 0:
            found = stock.filling(capacity - head, (head,))
            chosen = (head, *(found or ()))
            while not found:
                gap = capacity - sum(chosen)
                fit = next((l for l in range(min(gap, head), 0, -1) if stock.left[l] and stock.lasting((*chosen, l))), None)
                if fit is None:
                    break
                chosen = (*chosen, fit)
                found = stock.filling(capacity - sum(chosen), chosen, 2)
                chosen = (*chosen, *(found or ()))
            use(chosen)
    return out


def pack(
    df: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens.

    Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null text is the
    end token alone. Rows that share an id are packed each; null ids stay null. An empty table
    gives an empty result; other columns are ignored.

    The plan is made from the number of pieces of every length, ``capacity`` numbers. A piece's
    place follows from its number among the pieces of its length, counted over buckets of rows,
    so no task holds all pieces of a length.
    """
    flat = saved(
        pieces(df, id_column, text, tokenizer, capacity, end_id).withColumn("row", F.monotonically_increasing_id())
    )
    total = flat.count()
    buckets = max(1, -(-total // bucket_rows))
    flat = flat.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sums = saved(flat.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]

    # slots: the pieces numbered [first, first + times) of a length go to the sequences from
    # ``sequence`` on, at ``offset``
    slots, taken, sequence = defaultdict(list), np.zeros(capacity + 1, dtype=np.int64), 0
    for times, lengths in plan(counts, capacity):
        offset = 0
        for l in lengths:
            slots[l].append((taken[l], sequence, offset))
            taken[l] += times
            offset += l
        sequence += times
    table = {l: np.array(s, dtype=np.int64) for l, s in slots.items()}

    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    numbered = flat.withColumn("own", F.row_number().over(Window.partitionBy("bucket", "length").orderBy("row")) - 1)
    numbered = numbered.join(before.drop("n"), ["bucket", "length"]).withColumn("number", F.col("own") + F.coalesce("before", F.lit(0)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), dtype=np.int64)
        l, n = length.to_numpy(), number.to_numpy()
        for one in np.unique(l):
            at = np.flatnonzero(l == one)
            t = table[int(one)]
            slot = np.searchsorted(t[:, 0], n[at], side="right") - 1
            out[at, 0] = t[slot, 1] + n[at] - t[slot, 0]
            out[at, 1] = t[slot, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    return numbered.withColumn("p", place("length", "number")).select("doc_id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset")
