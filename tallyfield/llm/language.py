"""Language identification with hyperdimensional profiles of letter n-grams."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, hashed_fold, named, slices

POINTS = 0x110000
SYMBOLS = 128
UNKNOWN = "und"
DIMENSIONS = 512


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, for all of Unicode; 0 for what is no letter."""
    table = np.zeros(POINTS, dtype=np.int32)
    for c in range(POINTS):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = ord(chr(c).lower()[0])
    return table


@lru_cache(maxsize=1 << 16)
def _drawn(seed: int, letter: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng((seed, letter)).choice(np.array([-1, 1], dtype=np.int8), dimensions)


class Profiles:
    """Random letter vectors of +1 and -1. A letter's place in an n-gram permutes its vector (by
    rotation), an n-gram binds its letters (by products), a text bundles its n-grams (by sums)."""

    def __init__(self, dimensions: int = 512, n: int = 3, seed: int = 3):
        self.d, self.n, self.seed = dimensions, n, seed
        self.latin = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, dimensions))

    def vector(self, letter: int) -> np.ndarray:
        """The vector of a letter or, for 0, of a gap: a table for Latin up to U+00FF, else drawn from the code point."""
        if not letter:
            return self.latin[0]
        if 0x61 <= letter <= 0x7A:
            return self.latin[1 + letter - 0x61]
        if 0xDF <= letter <= 0xFF:
            return self.latin[27 + letter - 0xDF]
        return _drawn(self.seed, letter, self.d)

    def letters(self, text: str) -> np.ndarray:
        """The letters of a text with single gaps (0) between and around words; empty without enough of them."""
        s = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
        s = np.concatenate([[0], s, [0]])
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
        return s if len(s) >= self.n and s.any() else s[:0]

    def codes(self, s: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of numbered letters, as numbers, with the root of their counts."""
        code = np.zeros(len(s) - self.n + 1, dtype=np.int64)
        for k in range(self.n):
            code = code * base + s[k : k + len(code)]
        got, held = np.unique(code, return_counts=True)
        return got, np.sqrt(held).astype(np.float32)

    def bundle(self, texts) -> np.ndarray:
        """A unit vector for each text; zeros for texts without a letter."""
        found = [self.letters(t) if t else np.empty(0, dtype=np.int64) for t in texts]
        out = np.zeros((len(found), self.d), dtype=np.float32)
        if not any(len(s) for s in found):
            return out
        # the letters of these texts are numbered, so that an n-gram is one number
        seen = np.zeros(POINTS, dtype=bool)
        seen[0] = True
        for s in found:
            seen[s] = True
        own = np.flatnonzero(seen)
        if len(own) ** self.n >= 1 << 63:
            raise ValueError("n-grams too long for this many different letters")
        number = np.zeros(POINTS, dtype=np.int64)
        number[own] = np.arange(len(own))
        parts = [self.codes(number[s], len(own)) if len(s) else (np.empty(0, dtype=np.int64), None) for s in found]
        known = np.unique(np.concatenate([c for c, _ in parts]))
        vectors = np.stack([self.vector(int(x)) for x in own])
        grams = np.ones((len(known), self.d), dtype=np.int8)
        for k in range(self.n):
            grams *= np.roll(vectors, self.n - 1 - k, axis=1)[known // len(own) ** (self.n - 1 - k) % len(own)]
        grams = grams.astype(np.float32)
        for i, (code, weight) in enumerate(parts):
            if len(code):
                out[i] = weight @ grams[np.searchsorted(known, code)]
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


#: Sums of vectors are kept in whole units of this, so that they don't depend on the order of tasks.
UNIT = 2.0**-30


def fit_prototypes(train: DataFrame, text: str, lang: str, profiles: Profiles) -> tuple[list[str], np.ndarray]:
    """A prototype of each language: the bundle of all its texts' vectors. Every task adds up
    its own texts; only a vector for each language reaches the driver."""
    labelled = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("t"))

    def total(frames):
        sums: dict = {}
        for f in slices(frames, "t"):
            x = np.rint(profiles.bundle(list(f["t"])) / UNIT).astype(np.int64)
            for language in f["lang"].unique():
                sums[language] = sums.get(language, 0) + x[(f["lang"] == language).to_numpy()].sum(axis=0)
        for language, v in sums.items():
            yield pd.DataFrame({"lang": language, "i": np.arange(len(v), dtype=np.int32), "x": v})

    merged: dict = {}
    for language, i, x in labelled.mapInPandas(total, "lang string, i int, x long").groupBy("lang", "i").agg(F.sum("x").alias("x")).collect():
        merged.setdefault(language, np.zeros(profiles.d))[i] = x * UNIT
    names = sorted(k for k, v in merged.items() if np.abs(v).sum() > 0)
    if not names:
        return [], np.zeros((0, profiles.d))
    m = np.stack([merged[k] / np.sqrt((merged[k] ** 2).sum()) for k in names])
    return names, m


def identify(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 3,
    held_fold: int = 1,
    dimensions: int = DIMENSIONS,
    grams: int = 3,
) -> DataFrame:
    """The table with ``held_out``, ``lang_pred`` and ``score`` added, in place of columns of these names.

    Prototypes are learned from the text and non-null ``lang`` of all rows whose crc32(id as text)
    mod ``folds`` is not ``held_fold``. A text gets the language whose prototype has the largest
    cosine with its vector after both lose what all prototypes share (of equal cosines the first
    language by name); the score maps that cosine from -1..1 to 0..1. A text that is null or
    has no letter, and every text where nothing was learned, gets ``und`` and 0. Texts are read
    whole. A null id is held out of training and ``held_out`` false; repeated rows count as often
    as they are there. An empty table gives an empty result.
    """
    profiles = Profiles(dimensions, grams)
    fold = hashed_fold(id_column, folds)
    names, prototypes = fit_prototypes(df.where(fold != held_fold), text, lang, profiles)
    shared = prototypes.mean(axis=0) if len(names) > 1 else np.zeros(dimensions)
    own = prototypes - shared
    own = (own / np.maximum(np.sqrt((own * own).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)
    shared = shared.astype(np.float32)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = []
            for f in slices([pd.DataFrame({"t": texts})], "t"):
                x = profiles.bundle(list(f["t"]))
                some = (x != 0).any(axis=1) & bool(names)
                y = x - x @ shared[:, None] / max(float(shared @ shared), 1e-12) * shared[None, :]
                y = y / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-12)
                cosine = y @ own.T if names else np.zeros((len(f), 1))
                best = cosine.argmax(axis=1)
                found.append(pd.DataFrame({
                    "lang_pred": [names[b] if s else UNKNOWN for b, s in zip(best, some)],
                    "score": np.where(some, np.clip((1 + cosine[np.arange(len(f)), best]) / 2, 0, 1), 0.0),
                }))
            yield pd.concat(found, ignore_index=True) if found else pd.DataFrame({"lang_pred": [], "score": []})

    # the mark keeps filters on the results from running the function a second time
    found, out = fresh(df, "found"), ("held_out", "lang_pred", "score")
    return df.withColumn(found, predict.asNondeterministic()(text)).select(
        *[F.col(named(c)) for c in df.columns if c.lower() not in out],
        F.coalesce(fold == held_fold, F.lit(False)).alias("held_out"), f"{found}.lang_pred", f"{found}.score",
    )
