"""Log-bilinear language model trained with noise-contrastive estimation, and its scores.

The model's tokens are the end of a text, the most frequent words, and classes of all other
words by how often they occur, so every text gets a normalised probability: the class's from
the model, the word's within its class from corpus counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_fold, prefix_hashes, saved, slices, span_hashes, word_spans

PIECE = 1 << 20  # bytes of text that a step of a task works on
LN10 = math.log(10)


class LogBilinear:
    """p(w | h) = softmax over w of r_h . C . q_w + b_w, h being the token before w. Index 0 is the
    end token, which is the context of a text's first word too."""

    def __init__(self, size: int, width: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.context = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.map = np.eye(width, dtype=np.float32)
        self.bias = np.zeros(size, dtype=np.float32)

    def logits(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        return self.context[rows] @ self.map @ self.target.T + self.bias

    def fit(self, pairs: np.ndarray, steps: int, noise: float = 25.0, rate: float = 0.05, batch: int = 256) -> "LogBilinear":
        """``pairs[h, w]``: how often w follows h in the whole training corpus.

        Each step takes a batch of contexts and the exact expectation of the noise-contrastive
        objective over both the observed words and ``noise`` unigram draws per observed word,
        so the counts of all text enter and no sampling error does.
        """
        seen = pairs.sum(axis=1)
        q = unigram(pairs)
        self.bias = np.log(q).astype(np.float32)
        shift, q = np.log(noise * q).astype(np.float32), q.astype(np.float32)
        rng = np.random.default_rng(1)
        state, t = {}, 0
        for _ in range(steps):
            order = rng.permutation(len(seen))
            for at in range(0, len(order), batch):
                t += 1
                h = order[at : at + batch]
                # a context's weight grows with the root of its count: rare ones learn as well
                root = np.sqrt(seen[h])
                share = (root / max(1e-9, root.sum())).astype(np.float32)
                p = pairs[h].astype(np.float32) / np.maximum(seen[h], 1).astype(np.float32)[:, None]
                sig = 1 / (1 + np.exp(-np.clip(self.logits(h) - shift, -30, 30)))
                g = share[:, None] * (p * (1 - sig) - np.float32(noise) * q * sig)
                left = self.context[h] @ self.map
                grads = {
                    "context": (h, g @ self.target @ self.map.T - 1e-4 * share[:, None] * self.context[h]),
                    "target": (slice(None), g.T @ left - 1e-5 * self.target),
                    "map": (slice(None), self.context[h].T @ (g @ self.target)),
                    "bias": (slice(None), g.sum(axis=0)),
                }
                for name, (rows, grad) in grads.items():
                    value = getattr(self, name)
                    m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
                    m[rows] = 0.9 * m[rows] + 0.1 * grad
                    v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
                    value[rows] += rate / (1 + t / 200) * m[rows] / (1 - 0.9**t) / (np.sqrt(v[rows] / (1 - 0.99**t)) + 1e-8)
        return self

    def normalisers(self, batch: int = 512) -> np.ndarray:
        """The logarithm of each context's sum over all words."""
        out = []
        for at in range(0, len(self.bias), batch):
            z = self.logits(slice(at, at + batch)).astype(np.float64)
            top = z.max(axis=1)
            out.append(top + np.log(np.exp(z - top[:, None]).sum(axis=1)))
        return np.concatenate(out)


def unigram(pairs: np.ndarray) -> np.ndarray:
    q = pairs.sum(axis=0, dtype=np.float64) + 0.5
    return q / q.sum()


class Scorer:
    """Normalised probabilities of neighbouring tokens: the model's and, the more the rarer the context
    is, the unigram's; ``trust`` counts of a context weigh as much as the unigram."""

    def __init__(self, model: LogBilinear, seen: np.ndarray, q: np.ndarray, trust: float):
        self.left, self.target, self.bias = model.context @ model.map, model.target, model.bias.astype(np.float64)
        self.log_z, self.q, self.weight = model.normalisers(), q, trust / (seen + trust)

    def log10(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        fit = np.einsum("ij,ij->i", self.left[h], self.target[w]).astype(np.float64) + self.bias[w] - self.log_z[h]
        share = self.weight[h]
        return np.log((1 - share) * np.exp(fit) + share * self.q[w]) / LN10


def trained(pairs: np.ndarray, back: np.ndarray, width: int, steps: int) -> Scorer:
    """The model of all pair counts. How far it is trusted is chosen on those held back, by a model that has not seen
    them; then the model learns from them too."""
    model = LogBilinear(len(pairs), width).fit(pairs, steps)
    h, w = np.nonzero(back)
    seen, q, n = pairs.sum(axis=1, dtype=np.float64), unigram(pairs), back[h, w]

    def gain(trust):
        scorer = Scorer(model, seen, q, trust)
        return sum(float(n[at : at + PIECE] @ scorer.log10(h[at : at + PIECE], w[at : at + PIECE])) for at in range(0, len(h), PIECE))

    trust = max((100.0, 3.0, 10.0, 30.0, 300.0, 1e3, 3e3, 1e4, 1e5), key=gain)
    del h, w, n, model
    pairs += back
    return Scorer(LogBilinear(len(pairs), width).fit(pairs, steps), pairs.sum(axis=1, dtype=np.float64), unigram(pairs), trust)


def tokens_of(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its text) of every word of the texts, A-Z lower-cased; words are maximal runs without
    the bytes 0x20 and 0x09-0x0D, told apart by 64-bit hashes."""
    texts = [t or b"" for t in texts]
    raw = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
    start, end = word_spans(raw)
    stop = np.cumsum([len(t) + 1 for t in texts])
    return span_hashes(prefix_hashes(raw), start, end), np.searchsorted(stop, start, side="right")


def corpus_counts(train: DataFrame, flush: int = 4_000_000) -> DataFrame:
    """(word long, c): counts of all words of all training texts by their hashes, summed in each task first."""

    def count(frames):
        held, n = [], 0

        def out():
            words, c = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(words), 200_000):
                yield pd.DataFrame({"word": words[at : at + 200_000].view(np.int64), "c": c[at : at + 200_000]})

        for f in slices(frames, "t", PIECE):
            held.append(tokens_of(f["t"])[0])
            n += len(held[-1])
            if n > flush:
                yield from out()
                held, n = [], 0
        if held:
            yield from out()

    return train.select("t").mapInPandas(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The listed words, sorted by hash, with their counts and the model's tokens: 1 to m the ``most`` most
    frequent, then a class for every half power of two of a count. Words that occur once, those beyond
    the list and those never seen are the last class, which so learns where unknown words stand."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, most: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        ranked = np.lexsort((self.words, -self.counts))[: int((self.counts > 1).sum())]
        self.m = min(most, len(ranked))
        kinds, of = np.unique(-np.floor(2 * np.log2(self.counts[ranked[self.m :]])), return_inverse=True)
        self.size = self.m + len(kinds) + 2
        self.token = np.full(len(words), self.size - 1, dtype=np.int32)
        self.token[ranked[: self.m]] = np.arange(1, self.m + 1)
        self.token[ranked[self.m :]] = self.m + 1 + of

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, place in the list or -1) of words given by their hashes."""
        if not len(self.words):
            return np.full(len(words), self.size - 1, dtype=np.int32), np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        hit = self.words[at] == words
        return np.where(hit, self.token[at], self.size - 1).astype(np.int32), np.where(hit, at, -1)

    def stream(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of the texts one after the other, each text with its end (0); the text of each token;
        the words' hashes and places in the list."""
        words, doc = tokens_of(texts)
        token, at = self.find(words)
        held = np.bincount(doc, minlength=len(texts))
        flat, of = np.zeros(len(words) + len(texts), dtype=np.int32), np.repeat(np.arange(len(texts)), held + 1)
        flat[np.arange(len(words)) + doc] = token
        return flat, of, words, at


def _pair_counts(train: DataFrame, listed) -> DataFrame:
    """(pair, c, back) of neighbouring tokens over all training texts, those of the held-back ones apart."""

    def count(frames):
        vocabulary = listed.value
        size = vocabulary.size
        held = np.zeros((2, size * size), dtype=np.int64)
        for f in slices(frames, "t", PIECE):
            for part, g in f.groupby("back"):
                flat = vocabulary.stream(list(g["t"]))[0].astype(np.int64)
                codes, c = np.unique(np.concatenate([[0], flat[:-1]]) * size + flat, return_counts=True)
                held[int(part)][codes] += c
        at = np.flatnonzero(held.any(axis=0))
        for low in range(0, len(at), 200_000):
            some = at[low : low + 200_000]
            yield pd.DataFrame({"pair": some.astype(np.int32), "c": held[0][some], "back": held[1][some]})

    counted = train.select("t", "back").mapInPandas(count, "pair int, c long, back long")
    return counted.groupBy("pair").agg(F.sum("c").alias("c"), F.sum("back").alias("back"))


def score_texts(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    held_fold: int = 1,
    vocabulary: int = 2046,
    width: int = 32,
    steps: int = 30,
    known_words: int = 1_000_000,
) -> DataFrame:
    """Log10 probabilities of every whole text, from a model of the documents whose
    crc32(id as text) mod ``folds`` is not ``held_fold``.

    Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    Words are maximal runs without the bytes 0x20 and 0x09-0x0D, A-Z lower-cased, and each text
    ends with one end token; null texts count as empty. ``base_score`` is the smoothed unigram
    sum; ``score`` the model's. Counts of words and of neighbouring tokens cover the whole
    training corpus; a tenth of its documents chooses how far the model is trusted. Words of their own
    in the model are twice the root of the number of different words, ``vocabulary`` at most; all
    others are in classes by their counts. Only these tables reach the driver and every task: the
    pair counts of the model's tokens, and hashes and counts of at most ``known_words`` words, the most
    frequent (all of a count or none, in steps of an eighth power of two); the other words are
    joined with their counts. Rows with a null id count as training text (they have no fold);
    rows that share an id are scored each. With no training text the model knows the end token
    only. An empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    fold = hashed_fold(id_column, folds)
    docs = df.select(F.col(id_column).cast("long").alias("id"), F.coalesce(fold == held_fold, F.lit(False)).alias("held"), F.col(text).cast("binary").alias("t"))
    train = docs.where("not held").select("t", (F.pmod(F.xxhash64("id"), F.lit(10)) == 0).alias("back"))
    counts = saved(corpus_counts(train))
    ends = train.count()
    step = F.floor(8 * F.log2("c"))
    steps_held = sorted(((r["s"], r["n"], r["v"]) for r in counts.groupBy(step.alias("s")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()), reverse=True)
    n_words, v_words = sum(x[1] for x in steps_held), sum(x[2] for x in steps_held)
    n, v = n_words + ends, v_words + (ends > 0)
    total, least = 0, None
    for s, _, held in steps_held:
        if total + held > known_words:
            break
        total, least = total + held, s
    known = counts.where(step >= least).toArrow() if least is not None else None
    words = known["word"].to_numpy().view(np.uint64) if known is not None else np.empty(0, dtype=np.uint64)
    held_counts = known["c"].to_numpy() if known is not None else np.empty(0, dtype=np.int64)
    lexicon = Vocabulary(words, held_counts, min(vocabulary, math.ceil(2 * math.sqrt(v_words))))
    del known, words, held_counts

    listed = spark.sparkContext.broadcast(lexicon)
    size = lexicon.size
    got = _pair_counts(train, listed).toArrow()
    pairs, back = np.zeros(size * size, dtype=np.float32), np.zeros(size * size, dtype=np.float32)
    at = got["pair"].to_numpy()
    pairs[at], back[at] = got["c"].to_numpy(), got["back"].to_numpy()
    del got, at
    model = trained(pairs.reshape(size, size), back.reshape(size, size), width, steps)
    del pairs, back

    # a word of a class has the class's probability times its own share of the class; the last class holds
    # one word never seen, too
    base_total = n + 0.5 * (v + 1)
    mass = np.bincount(lexicon.token, weights=lexicon.counts + 0.5, minlength=size)
    mass[-1] += n_words - int(lexicon.counts.sum()) + 0.5 * (v_words - len(lexicon.words) + 1)
    shift = np.log10(base_total) - np.log10(np.maximum(mass, 0.5))  # from log10 of the base to that within the class
    own = np.arange(size) <= lexicon.m
    end_base = float(np.log10((ends + 0.5) / base_total))
    scoring = spark.sparkContext.broadcast((model, shift, own))

    def score(frames):
        lexicon, (model, shift, own) = listed.value, scoring.value
        base_of = np.append(np.log10((lexicon.counts + 0.5) / base_total), 0.0)  # the last for words beyond the list
        for f in slices(frames, "t", PIECE):
            flat, doc, words, at = lexicon.stream(list(f["t"]))
            log = model.log10(np.concatenate([[0], flat[:-1]]), flat)
            inside = flat != 0
            base = np.full(len(flat), end_base)
            base[inside] = base_of[at]
            log += np.where(own[flat], 0.0, base + shift[flat])
            n_docs = len(f)
            place, tail = doc[inside], at < 0
            cells, inverse, times = np.unique(np.stack([place[tail], words[tail].view(np.int64)]), axis=1, return_inverse=True, return_counts=True)
            cut = np.searchsorted(cells[0], np.arange(1, n_docs))
            yield pd.DataFrame({
                "row": f["row"], "id": f["id"].astype("Int64"), "held": f["held"], "n_tokens": np.bincount(doc, minlength=n_docs),
                "n_known": np.bincount(place[~tail], minlength=n_docs) + int(ends > 0),
                "base": np.bincount(doc, weights=base, minlength=n_docs), "model": np.bincount(doc, weights=log, minlength=n_docs),
                "words": np.split(cells[1], cut), "times": np.split(times, cut),
            })

    schema = "row long, id long, held boolean, n_tokens long, n_known long, base double, model double, words array<long>, times array<long>"
    part = saved(docs.withColumn("row", F.monotonically_increasing_id()).mapInPandas(score, schema))
    listed.unpersist()
    scoring.unpersist()
    # words beyond the list: their counts by a join, summed by text
    rare = part.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    tail = counts if least is None else counts.where(step < least)
    log = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(float(base_total)))
    rare = rare.join(tail, "word", "left").groupBy("row").agg(F.sum(F.col("times") * log).alias("more"), F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("found"))
    more = F.coalesce("more", F.lit(0.0))
    return part.drop("words", "times").join(rare, "row", "left").select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
