"""SentencePiece encoding by one pass of an Aho-Corasick automaton over the pieces, and decoding.

The models merge neighbouring pieces, best score first. Such an encoding is known by its neighbours: a
sequence of pieces is the encoding of its text just if every two neighbours are that of
theirs. The Viterbi pass therefore relaxes a position only with pieces that may follow the
piece that ends where they start; the result is the model's own encoding.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SPACE = "▁"
CACHED_CHARS, CACHED_WORDS, CACHED_PAIRS = 48, 600_000, 1_000_000


class Words(dict):
    """The ids of words as bytes of int32, found when first asked for; those of long words aren't kept."""

    def __init__(self, model: PieceModel):
        self.segment = model.segment

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.segment(word)).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class PieceModel:
    """The pieces and scores of a model file, with an Aho-Corasick automaton over them."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        self.silent = {i for i in range(n) if model.is_control(i)}
        plain = [i for i in range(n) if not (i in self.byte_of or i in self.silent or model.is_unknown(i) or model.is_unused(i))]
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.pieces[i], (i + 1, len(self.pieces[i]), model.get_score(i)))
        self.automaton.make_automaton()
        self.floor = min((model.get_score(i) for i in plain if model.get_score(i) > -1e8), default=0.0) - 10.0
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        self.single = {self.pieces[i] for i in plain if len(self.pieces[i]) == 1}
        # what an id adds to a decoded text; a byte piece waits for those beside it
        self.spoken = [None if i in self.byte_of else "" if i in self.silent else self.pieces[i].replace(SPACE, " ") for i in range(n)]
        self.following: dict = defaultdict(dict)
        self.pairs = 0
        # where no piece has a space after another character, words are segmented on their own, and
        # so are a word's parts beside characters without a piece
        spaced = any(SPACE in self.pieces[i].lstrip(SPACE) for i in plain)
        known = re.escape("".join(sorted({c for p in self.score for c in p} - {SPACE})))
        self.split = re.compile("(?s).+" if spaced or not known else f"(?s){SPACE}*[{known}]+|{SPACE}+|[^{SPACE}{known}]+").findall
        self.cache = Words(self)
        self.known = self.cache.__getitem__

    def merged(self, text: str, border: int = 0) -> list[str] | None:
        """A short text by merging: of neighbours that form a piece the best-scoring first, the first of equal ones.
        None as soon as a merge goes over the ``border``, a number of characters, where one is given."""
        parts, score, none = list(text), self.score.get, -np.inf
        values = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while values and (best := max(values)) > none:
            at = values.index(best)
            if border:
                if at == border - 1:
                    return None
                border -= at < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del values[at]
            if at < len(values):
                values[at] = score(parts[at] + parts[at + 1], none)
            if at:
                values[at - 1] = score(parts[at - 1] + parts[at], none)
        return parts

    def named(self, state: int) -> str:
        """The piece of a state: 0 is the start, then the pieces by id, then characters without a piece."""
        n = len(self.pieces)
        return "" if not state else self.pieces[state - 1] if state <= n else chr(state - 1 - n)

    def follows(self, first: int, second: int) -> bool:
        """Whether merging leaves the pieces of two states as they are, one after the other."""
        a, b = self.named(first), self.named(second)
        known = self.merged(a + b, len(a)) == ([a, b] if first else [b])
        if self.pairs >= CACHED_PAIRS:
            self.following.clear()
            self.pairs = 0
        self.pairs += 1
        self.following[first][second] = known
        return known

    def segment(self, chunk: str) -> list[int]:
        """One pass of the automaton: at each end position all pieces that end there (the state's
        and those behind its output links) relax the best score, if they may follow the piece that the
        best way to their start ends with; a character that is no piece may stand for itself at
        the cost ``floor`` and becomes its bytes. Ties go to the longer last piece."""
        n, following = len(chunk), self.following
        best, back, sizes, after = [0.0] + [None] * n, [0] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        after[0] = following[0]
        found = self.automaton.iter(chunk)
        if not self.single.issuperset(chunk):
            alone = [(k, (len(self.pieces) + 1 + ord(c), 1, self.floor)) for k, c in enumerate(chunk) if c not in self.single]
            found = sorted([*found, *alone], key=lambda x: x[0])
        for end, (state, size, score) in found:
            end += 1
            start = end - size
            before = best[start]
            if before is None:
                continue
            total, held = before + score, best[end]
            if held is None or total > held or total == held and size > sizes[end]:
                known = after[start].get(state)
                if self.follows(back[start], state) if known is None else known:
                    best[end], back[end], sizes[end], after[end] = total, state, size, following[state]
        out, pieces = [], len(self.pieces)
        while n:
            state = back[n]
            if state > pieces:
                out += [self.bytes.get(b, self.unknown) for b in reversed(self.named(state).encode("utf-8", "surrogatepass"))]
            else:
                out.append(state - 1)
            n -= sizes[n]
        return out[::-1]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        # a literal space mark is no space: it stands aside and becomes its bytes
        parts = re.split(f"([{SPACE}])", text) if SPACE in text else [text]
        out, known = [], self.known
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.bytes.get(b, self.unknown) for b in part.encode()], dtype=np.int32).tobytes())
                continue
            chunk = part.replace(" ", SPACE)
            if k == 0:
                chunk = SPACE + chunk
            out += map(known, self.split(chunk))
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids) -> str:
        out, raw = [], bytearray()
        said = list(map(self.spoken.__getitem__, np.asarray(ids).tolist()))
        if None in said:
            for i, x in zip(map(int, ids), said):
                if x is None:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(x)
            if raw:
                out.append(raw.decode("utf-8", "replace"))
            said = out
        text = "".join(said)
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The model file has to lie at the same path on every executor, like any tokenizer."""
    return PieceModel(path)


def encode_pieces(df: DataFrame, model: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids that the model itself gives the text.

    A space mark is put before the text and stands for each space. Characters without a piece
    become byte pieces (or the unknown piece where the model has none), and so does a literal
    space mark, which the model would take for a space: decoding gives every text back. Null and empty
    texts have no ids. One row per row, null and shared ids as they are; other columns are ignored.
    """

    def run(frames):
        encode = piece_model(model).encode
        for f in slices(frames, "t"):
            yield pd.DataFrame({"doc_id": f["id"].astype("Int64"), "ids": [encode(t) for t in f["t"]]})

    return df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(run, "doc_id long, ids array<int>")


def decode_pieces(df: DataFrame, model: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text): the inverse of ``encode_pieces``; null ids give a null text."""

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        decode = piece_model(model).decode
        return pd.Series([None if x is None else decode(x) for x in batch], dtype=object)

    return df.select(F.col(id_column).cast("long").alias("doc_id"), run(ids).alias("text"))
