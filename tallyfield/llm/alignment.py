"""Alignment of two tokenizations of the same texts by a sweep over their tokens' ends."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, release, saved, slices
from .packing import byte_bpe

#: Bytes of a document whose token ends travel in one row.
RANGE = 1 << 16
#: Tokens that a sweep takes in at a time.
STEP = 1 << 20


@lru_cache(maxsize=2)
def piece_bytes(path: str):
    """The piece model of the file and the bytes that each of its ids stands for."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    held = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        held.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, held


@lru_cache(maxsize=2)
def byte_tokens(path: str):
    """The byte-level tokenizer of the file and the bytes of each of its ids."""
    model = byte_bpe(path)
    return model, [model.decode_single_token_bytes(i) for i in range(model.n_vocab)]


#: Words of at most so many characters are kept with their ids, so many of them.
CACHED_CHARS, CACHED_WORDS = 48, 600_000


class WordPieces:
    """The model's ids of texts, word by word: no piece has a space mark behind another character, so none
    crosses a word's border, and a word's ids don't depend on what is around it."""

    def __init__(self, path: str):
        self.model = piece_bytes(path)[0]
        n = self.model.get_piece_size()
        whole = any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(n))
        self.split = re.compile("(?s).+" if whole else " *[^ ]+").findall
        self.kind = _id_type(n)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts) -> list[np.ndarray]:
        """Words are found in one call for all of the texts; texts with a literal space mark, or with a
        space at their end, which is a word without a character, are left to the model."""
        known, none = self.known, np.empty(0, dtype=self.kind)
        if len(known) > CACHED_WORDS:
            known.clear()
        words = [self.split(" " + t) if t and "▁" not in t and t[-1] != " " else None for t in texts]
        new = list(set().union(*(w for w in words if w)).difference(known))
        found = {w: np.array(ids, dtype=self.kind).tobytes() for w, ids in zip(new, self.model.encode([w[1:] for w in new]))} if new else {}
        known.update(found)
        out = []
        for t, w in zip(texts, words):
            if w:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, w)), dtype=self.kind))
            else:
                out.append(np.array(self.model.encode(t), dtype=self.kind) if t else none)
        for w in found:
            if len(w) > CACHED_CHARS:
                del known[w]
        return out


@lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)


def _id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def end_events(docs: DataFrame, tokenizer: str, piece_model: str) -> DataFrame:
    """(row, id, at, side, ids): the tokens of both sides whose ends lie in the byte range that begins at
    ``at``, by document. An end's offset follows from the bytes of its side's ids before it, so the
    ids are all that has to travel. A document without tokens has one row, of side 2."""

    def encode(frames):
        (a_model, a_bytes), (b_model, b_bytes) = byte_tokens(tokenizer), piece_bytes(piece_model)
        pieces = word_pieces(piece_model)
        sizes = [np.array([len(x) for x in held], dtype=np.int64) for held in (a_bytes, b_bytes)]
        kinds = [_id_type(len(a_bytes)), _id_type(len(b_bytes))]
        for f in slices(frames, "t"):
            rows = []
            for row, doc, t, b in zip(f["row"], f["id"], f["t"], pieces(f["t"])):
                both = None
                if t:
                    whole, a = (" " + t).encode(), a_model.encode_to_numpy(" " + t, disallowed_special=())
                    ends = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
                    # tokens of A are stretches of the text one after the other, so their size tells whether any are missing
                    if len(a) and ends[0][-1] == len(whole) and b"".join(map(b_bytes.__getitem__, b.tolist())) == whole:
                        both = (a, ends[0]), (b, ends[1])
                if both is None:
                    rows.append((row, doc, 0, 2, b""))
                    continue
                for side, (ids, ends) in enumerate(both):
                    ids = ids.astype(kinds[side], copy=False)
                    for k in range(int(ends[0]) // RANGE, int(ends[-1]) // RANGE + 1):
                        low, high = np.searchsorted(ends, [k * RANGE, (k + 1) * RANGE])
                        if low < high:
                            rows.append((row, doc, k * RANGE, side, ids[low:high].tobytes()))
            out = pd.DataFrame(rows, columns=["row", "id", "at", "side", "ids"])
            yield out.assign(id=out["id"].astype("Int64"))

    return docs.mapInPandas(encode, "row long, id long, at long, side int, ids binary")


def spread(key):
    """Scattered low bits of a pair's key, an array or a column; nothing of it overflows a long."""
    x = key % 1_000_003 * 40_503
    return x >> np.uint64(8) if isinstance(x, np.ndarray) else F.shiftright(x, 8)


class Sweep:
    """Runs once over the ends of documents that come one after the other, each side's in order.

    Two sides of a document have equal bytes, so their streams agree on where every document ends, and
    the whole stream is swept like one text. All that is kept between steps is what follows the last
    common end, and of the document that is still open its pairs, counts and hash.
    """

    def __init__(self, sizes: list[np.ndarray], buckets: int, keep_groups: bool):
        self.sizes, self.keep_groups = sizes, keep_groups
        self.shift = max(1, (len(sizes[1]) - 1).bit_length())
        self.bits = self.shift + max(1, (len(sizes[0]) - 1).bit_length())
        self.bucket_bits = (buckets - 1).bit_length()
        names = [str(i).encode() for i in range(max(map(len, sizes)))]
        self.width = len(names[-1]) + 1
        self.digits = np.array([len(x) for x in names])
        self.text = np.frombuffer(b"".join(x.ljust(self.width) for x in names), dtype=np.uint8).reshape(-1, self.width)
        self.docs: list[tuple] = []  # the open document and those of the step, as (row, id)
        self.rest = [np.empty(0, dtype=np.int64)] * 2
        self.counts = np.zeros(4, dtype=np.int64)
        self.open_text, self.open_pairs = None, (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))

    def bucket_of(self, key: np.ndarray) -> np.ndarray:
        return spread(key) & np.uint64((1 << self.bucket_bits) - 1)

    def _written(self, text: np.ndarray, more: bool) -> None:
        """Adds a step's groups, less their last separator, to the open document's."""
        if self.open_text is None:
            self.open_text = [] if self.keep_groups else hashlib.sha256()
            add = b""
        else:
            add = b";"
        add += text[:-1].tobytes()
        self.open_text.append(add) if self.keep_groups else self.open_text.update(add)

    def _close(self) -> str:
        held, self.open_text = self.open_text, None
        if held is None:
            return ""
        return b"".join(held).decode() if self.keep_groups else held.hexdigest()

    def step(self, parts: list[list[tuple[int, np.ndarray]]], last: bool):
        """Sweeps the events (number of the document, ids) of the two sides. Gives the closed
        documents' results and pairs: (docs, counts, groups), (number, bucket, keys, occurrences)."""
        ids, doc, ends = [], [], []
        for side in (0, 1):
            held = [(0, self.rest[side]), *parts[side]]
            ids.append(np.concatenate([x.astype(np.int64) for _, x in held]))
            doc.append(np.repeat([k for k, _ in held], [len(x) for _, x in held]))
            ends.append(np.cumsum(self.sizes[side][ids[side]]))
        # all ends in order, each once, and which side's they are
        size = max((int(e[-1]) for e in ends if len(e)), default=0) + 1
        is_end = np.zeros((2, size), dtype=bool)
        for side in (0, 1):
            is_end[side, ends[side]] = True
        both = np.flatnonzero(is_end[0] | is_end[1])
        in_a, in_b = is_end[0, both], is_end[1, both]
        shared = np.flatnonzero(in_a & in_b)
        stop = int(shared[-1]) + 1 if len(shared) else 0
        both, in_a, in_b = both[:stop], in_a[:stop], in_b[:stop]
        a_last, b_last = int(in_a.sum()), int(in_b.sum())
        self.rest = [ids[0][a_last:], ids[1][b_last:]]
        n, counts = len(self.docs), np.zeros((len(self.docs), 4), dtype=np.int64)
        code, times = self.open_pairs
        marks = np.zeros(n + 1, dtype=np.int64)
        text = np.empty(0, dtype=np.uint8)
        if a_last:
            a, b, a_doc, b_doc = ids[0][:a_last], ids[1][:b_last], doc[0][:a_last], doc[1][:b_last]
            a_common, b_common = in_b[in_a], in_a[in_b]
            # between two ends in a row lies one token of either side: a link
            i, j = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
            key = ((a[i] << self.shift) | b[j]).astype(np.uint64)
            for column, numbers in enumerate((a_doc, b_doc, a_doc[a_common], a_doc[i])):
                counts[:, column] = np.bincount(numbers, minlength=n)
            place = (a_doc[i].astype(np.uint64) << np.uint64(self.bucket_bits)) | self.bucket_of(key)
            found, seen = np.unique((place << np.uint64(self.bits)) | key, return_counts=True)
            code, times = _summed(np.concatenate([code, found]), np.concatenate([times, seen])) if len(code) else (found, seen)
            # a group's ids of A come first, then its ids of B
            of_a, of_b = np.cumsum(a_common) - a_common, np.cumsum(b_common) - b_common
            a_before, b_before = np.flatnonzero(a_common)[of_b] + 1, np.append(0, np.flatnonzero(b_common) + 1)[of_a]
            merged, sign = np.empty(a_last + b_last, dtype=np.int64), np.full(a_last + b_last, ord(","), dtype=np.uint8)
            to_a, to_b = np.arange(a_last) + b_before, np.arange(b_last) + a_before
            merged[to_a], merged[to_b] = a, b
            sign[to_a[a_common]], sign[to_b[b_common]] = ord("|"), ord(";")
            written = self.text[merged]
            length = self.digits[merged]
            written[np.arange(len(merged)), length] = sign
            text = written[np.arange(self.width) <= length[:, None]]
            held = np.concatenate([[0], np.cumsum(length + 1)])
            marks = held[np.searchsorted(a_doc, np.arange(n + 1)) + np.searchsorted(b_doc, np.arange(n + 1))]
        closed = n if last else n - 1
        counts[0] += self.counts
        groups = []
        for k in range(n):
            if marks[k] < marks[k + 1]:
                self._written(text[marks[k] : marks[k + 1]], k < closed)
            if k < closed:
                groups.append(self._close())
        out = self.docs[:closed], counts[:closed], groups
        cut = int(np.searchsorted(code >> np.uint64(self.bits + self.bucket_bits), closed)) if len(code) else 0
        done, self.docs, self.counts = (code[:cut], times[:cut]), self.docs[closed:], counts[closed] if closed < n else np.zeros(4, dtype=np.int64)
        self.open_pairs = code[cut:] & np.uint64((1 << (self.bits + self.bucket_bits)) - 1), times[cut:]
        return out, done

    def run(self, batches):
        """The sweep over Arrow batches of ``end_events``, sorted by row, offset and side."""
        kinds = [_id_type(len(s)) for s in self.sizes]
        parts, size = [[], []], 0
        for batch in batches:
            for row, doc, side, ids in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "side", "ids"))):
                if not self.docs or self.docs[-1][0] != row:
                    if size >= STEP:
                        yield self.step(parts, False)
                        parts, size = [[], []], 0
                    self.docs.append((row, doc))
                elif size >= 2 * STEP:
                    yield self.step(parts, False)
                    parts, size = [[], []], 0
                if side < 2:
                    found = np.frombuffer(ids, dtype=kinds[side])
                    parts[side].append((len(self.docs) - 1, found))
                    size += len(found)
        if self.docs:
            yield self.step(parts, True)


def _summed(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes with the sums of their numbers."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(times[order], first)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(events: DataFrame, sizes: list[np.ndarray], buckets: int, keep_groups: bool) -> DataFrame:
    """(row, id, bucket, keys, occurrences, n_a, n_b, n_groups, n_links, groups): of every document a row of results
    (bucket null), and its distinct linked pairs dealt over buckets."""

    def sweep(batches):
        state = Sweep(sizes, buckets, keep_groups)
        whole = pa.int32() if state.bits <= 31 else pa.int64()
        fields = [("row", pa.int64()), ("id", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(whole)), ("occurrences", pa.list_(pa.int32()))]
        schema = pa.schema([*fields, *[(n, pa.int64()) for n in NUMBERS], ("groups", pa.string())])

        def batch(n, **columns):
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        for (docs, counts, groups), (code, times) in state.run(batches):
            if docs:
                yield batch(
                    len(docs), row=pa.array([r for r, _ in docs], pa.int64()), id=pa.array([d for _, d in docs], pa.int64()),
                    groups=pa.array(groups, pa.string()), **{n: pa.array(counts[:, k]) for k, n in enumerate(NUMBERS)},
                )
            if len(code):
                place = code >> np.uint64(state.bits)
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                offsets = pa.array(np.append(first, len(code)).astype(np.int32))
                keys = (code & np.uint64((1 << state.bits) - 1)).astype(np.int32 if state.bits <= 31 else np.int64)
                numbers, bucket = (place[first] >> np.uint64(state.bucket_bits)).astype(np.int64), place[first] & np.uint64(buckets - 1)
                rows = np.array([r for r, _ in docs], dtype=np.int64)
                yield batch(
                    len(first), row=pa.array(rows[numbers]), bucket=pa.array(bucket.astype(np.int32)),
                    keys=pa.ListArray.from_arrays(offsets, pa.array(keys)), occurrences=pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                )

    bits = sum(max(1, (len(s) - 1).bit_length()) for s in sizes)
    key = "int" if bits <= 31 else "long"
    schema = f"row long, id long, bucket int, keys array<{key}>, occurrences array<int>, {', '.join(f'{n} long' for n in NUMBERS)}, groups string"
    return events.repartition("row").sortWithinPartitions("row", "at", "side").mapInArrow(sweep, schema)


def pair_counts(found: DataFrame, shift: int) -> DataFrame:
    """(bucket, key, n, best): how many documents hold each linked pair, and whether no other pair of its A id is in more."""

    def count(batches):
        held, times, more = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), []

        def merged():
            keys = np.concatenate([held, *[k for k, _ in more]])
            return _summed(keys, np.concatenate([times, *[n for _, n in more]])) if len(keys) else (held, times)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held), pa.array(times)], names=["key", "n"])

        size = 0
        for batch in batches:
            more.append(np.unique(batch.column("keys").flatten().to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True))
            size += len(more[-1][0])
            if size > STEP:
                (held, times), more, size = merged(), [], 0
                if len(held) > 4 * STEP:
                    yield out()
                    held, times = held[:0], times[:0]
        held, times = merged()
        if len(held):
            yield out()

    counts = found.where("bucket is not null").select("keys").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = saved(counts.withColumn("a", F.shiftright("key", shift)))
    return counts.join(counts.groupBy("a").agg(F.max("n").alias("most")), "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(
    df: DataFrame,
    tokenizer: str,
    piece_model: str,
    id_column: str = "doc_id",
    text: str = "text",
    keep_groups: bool = True,
    buckets: int = 64,
    bucket_docs: int = 100_000,
) -> DataFrame:
    """How two tokenizers cut the same texts: per row of the input ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups``.

    A is the byte-level tokenizer on a space and the text, B the piece model on the text, which adds
    that space; strings of special tokens are plain text. Where a token of A and one of B end together, a group
    ends. Tokens whose bytes overlap are linked. The count of a pair of ids is the number of documents that
    hold it linked; ``count_sum`` adds it up over a document's links, ``n_best`` are the links whose count is
    the highest of their A id (ties included). ``groups`` is ``a1,a2|b1;a3|b2,b3``, or its SHA-256 in lower-case hex
    without ``keep_groups``.

    A text that is null or empty, or that one of the tokenizers doesn't give back byte by byte (one with
    a literal U+2581, for instance), has no tokens: zeros and ''. Rows that share an id, and repeated rows, are
    documents each, in counts too; null ids stay null. Very long texts are tokenized whole and swept in steps; an
    empty table gives an empty result; other columns are ignored.

    ``buckets`` (a power of two) and ``bucket_docs`` set how a document's pairs meet the counts: a task
    holds the counts of one bucket of pairs and streams so many documents' pairs past them.
    """
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    sizes = [np.array([len(x) for x in held], dtype=np.int64) for held in (byte_tokens(tokenizer)[1], piece_bytes(piece_model)[1])]
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col(named(id_column)).cast("long").alias("id"), F.col(named(text)).alias("t"))
    found = saved(aligned(end_events(docs, tokenizer, piece_model), sizes, buckets, keep_groups))
    state = Sweep(sizes, buckets, False)
    counts = saved(pair_counts(found, state.shift))
    total = found.where("bucket is null").count()
    salts = max(1, -(-total // bucket_docs))
    bucket = spread(F.col("key")).bitwiseAND(F.lit(buckets - 1))
    # counts travel packed, some thousand in a row, to every part of their bucket
    packed = counts.select(bucket.cast("int").alias("bucket"), F.pmod(F.xxhash64("key"), F.lit(max(1, counts.count() // (buckets * 4096)))).alias("block"), F.struct("key", "n", "best").alias("x"))
    packed = packed.groupBy("bucket", "block").agg(F.collect_list("x").alias("x")).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row"),
        F.transform("x", lambda x: x["key"]).alias("keys"), F.transform("x", lambda x: x["n"] * 2 + x["best"].cast("long")).alias("value"),
    )
    asked = found.where("bucket is not null").select(
        "bucket", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "row",
        F.col("keys").cast("array<long>").alias("keys"), F.col("occurrences").cast("array<long>").alias("value"),
    )

    def look_up(batches):
        place, held, keys, value = None, [], None, None
        for batch in batches:
            cell = batch.column("bucket").to_numpy().astype(np.int64) * (1 << 32) + batch.column("salt").to_numpy()
            kind = batch.column("kind").to_numpy()
            starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])))
            for low, high in zip(starts, np.append(starts[1:], len(cell))):
                part = batch.slice(low, high - low)
                x, y = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("keys", "value"))
                if cell[low] != place:
                    place, held, keys = cell[low], [], None
                if kind[low] == 0:
                    held.append((x, y))
                    continue
                if keys is None:
                    keys, value = (np.concatenate(z) for z in zip(*held))
                    order, held = np.argsort(keys), []
                    keys, value = keys[order], value[order]
                got = value[np.searchsorted(keys, x)]
                first = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(part.column("keys")).to_numpy())[:-1]])
                sums = [np.add.reduceat(z, first) for z in (y * (got & 1), y * (got >> 1))]
                yield pa.RecordBatch.from_arrays([part.column("row"), *map(pa.array, sums)], names=["row", "n_best", "count_sum"])

    import pyarrow.compute  # noqa: F401  (pa.compute, in tasks too)

    met = packed.union(asked).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "kind").mapInArrow(look_up, "row long, n_best long, count_sum long")
    none = [F.lit(None).cast("long").alias(n) for n in ("id", *NUMBERS)]
    results = found.where("bucket is null").select("row", "id", *NUMBERS, "groups", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    both = results.union(met.select("row", *none, F.lit(None).cast("string"), "n_best", "count_sum"))
    out = both.groupBy("row").agg(*[F.max(c).alias(c) for c in ("id", *NUMBERS, "groups")], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return out.select(F.col("id").alias("doc_id"), *NUMBERS, "n_best", "count_sum", "groups")
