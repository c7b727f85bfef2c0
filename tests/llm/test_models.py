"""Language identification and language-model scores: held-out accuracy and plain versions."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import language, lm

from .helpers import documents, edge_texts, table, words

SMALL = {"vocabulary": 60, "width": 8, "steps": 5, "known_words": 80}


def remainder(i, folds):
    return None if i is None else zlib.crc32(str(i).encode()) % folds


# ------------------------------------------------------------------ language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs)
    row = got.where("held_out and lang is not null and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert row[1] > 100 and row[0] > 0.95
    assert got.count() == docs.count()


def test_language_edges(spark):
    rows = edge_texts() + [(50, "1234 5678 !!"), (51, "٣ – 9")]
    got = language.identify(documents(spark, rows))
    assert len(set(got.columns)) == len(got.columns)
    held = got.select("doc_id", "text", "held_out", "lang_pred", "score").collect()
    assert len(held) == len(rows)
    for r in held:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (remainder(r["doc_id"], 3) == 1)
    empty = language.identify(documents(spark, []))
    assert empty.count() == 0
    unlabelled = language.identify(documents(spark, rows).withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_language_of_tables_with_empty_partitions_and_clashing_names(spark):
    rows = [(1, "the river and the stone", "en"), (2, "der Fluss und der Stein", "de"), (3, "the window and the lamp", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"_found": F.lit(1), "_p": F.lit(2), "Score": F.lit("x"), "a.b": F.lit(3)})
    got = language.identify(df.repartition(16))
    assert got.columns == ["doc_id", "text", "lang", "_found", "_p", "a.b", "held_out", "lang_pred", "score"]
    assert [r["_p"] for r in got.collect()] == [2, 2, 2]


def plain_bundle(profiles, text):
    """The vector of a text, n-gram by n-gram."""
    letters = [" "]
    for c in text or "":
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or letters[-1] != " ":
            letters.append(c)
    letters += [" "] if letters[-1] != " " else []
    count = Counter(tuple(letters[k : k + 3]) for k in range(len(letters) - 2))
    v = np.zeros(profiles.d)
    for gram, n in count.items():
        one = np.ones(profiles.d)
        for k, c in enumerate(gram):
            one *= np.roll(profiles.vector(0 if c == " " else ord(c)), 2 - k)
        v += math.sqrt(n) * one
    return v / math.sqrt(v @ v) if v.any() else v


def test_language_equals_a_plain_version(spark):
    docs = table(spark, "documents").where("n_chars < 1500")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()] + [(10**6 + k, t, "en") for k, t in enumerate(["", "12", "é", "日本 語", "\U00010428x", None])]
    profiles = language.Profiles()
    vectors = {i: plain_bundle(profiles, t) for i, t, _ in rows}
    names = sorted({l for _, _, l in rows})
    m = np.stack([sum(vectors[i] for i, _, l in rows if l == n and remainder(i, 3) != 1) for n in names])
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    shared = m.mean(axis=0)
    own = m - shared
    own /= np.sqrt((own * own).sum(axis=1, keepdims=True))
    want = {}
    for i, t, _ in rows:
        v = vectors[i]
        if not v.any():
            want[i] = ("und", 0.0)
            continue
        v = v - (v @ shared) / (shared @ shared) * shared
        cosine = own @ (v / math.sqrt(v @ v))
        want[i] = (names[int(cosine.argmax())], (1 + cosine.max()) / 2)
    df = spark.createDataFrame([(i, t, l) for i, t, l in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(df).collect()}
    assert got.keys() == want.keys() and len(want) > 50
    for i, (name, score) in want.items():
        assert got[i][0] == name and abs(got[i][1] - score) < 1e-4


# ------------------------------------------------------------------ language model


def brute_base(rows, folds=5):
    train = Counter()
    for i, t in rows:
        if remainder(i, folds) != 1:
            train.update(words(t))
            train[None] += 1
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((i, remainder(i, folds) == 1, len(tokens), sum(train[w] > 0 for w in tokens), n, round(base, 4)))
    return sorted(out, key=str)


def got_base(df, **kw):
    rows = lm.score_texts(df, **kw).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    return sorted(((*r[:5], round(r["base_score"], 4)) for r in rows), key=str)


def test_lm_edges(spark):
    rows = edge_texts()
    assert got_base(documents(spark, rows), **SMALL) == brute_base(rows)
    assert lm.score_texts(documents(spark, []), **SMALL).count() == 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_lm_beats_the_base_on_held_out_texts(spark, size):
    base, score = lm.score_texts(spark.read.parquet(f"/root/testdata/{size}/documents.parquet")).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_lm_base_of_documents(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = lm.score_texts(docs).cache()
    assert sorted(((*r[:5], round(r[5], 4)) for r in got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()), key=str) == brute_base(rows)


def test_lm_training_finds_a_small_case_exactly():
    """Noise-contrastive training with its exact expectation: probabilities of a table of full rank come out as counted."""
    rng = np.random.default_rng(7)
    truth = rng.dirichlet(np.full(7, 0.7), 7)
    pairs = np.rint(truth * 20000).astype(np.float32)
    model = lm.LogBilinear(7, 7).fit(pairs, 1500)
    z = model.logits().astype(np.float64)
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    want = pairs / pairs.sum(axis=1, keepdims=True)
    assert np.abs(p - want).max() < 0.02
    # the objective's constant is learned with it: the sums are one without normalising
    assert np.abs(np.exp(z).sum(axis=1) - 1).max() < 0.05


def test_lm_learns_from_the_counts_held_back_too():
    pairs, back = np.zeros((5, 5), dtype=np.float32), np.zeros((5, 5), dtype=np.float32)
    pairs[1, 2] = pairs[2, 1] = 500
    back[3, 4] = 400
    back[1, 2] = 40
    scorer = lm.trained(pairs, back, 4, 60)
    assert 10 ** float(scorer.log10(np.array([3]), np.array([4]))[0]) > 0.5


def test_lm_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(0.4, (40, 40)).astype(np.float32)
    scorer = lm.trained(pairs, rng.poisson(0.1, (40, 40)).astype(np.float32), 8, 5)
    h, w = np.divmod(np.arange(1600), 40)
    assert np.allclose((10.0 ** scorer.log10(h, w)).reshape(40, 40).sum(axis=1), 1, atol=1e-4)


def test_lm_score_equals_a_plain_version(spark):
    """The same model, from counts by plain loops: classes, pairs, and a sum over the tokens of each text."""
    docs = table(spark, "documents").where("n_chars < 3000")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(docs, vocabulary=30, width=4, steps=3, known_words=100).collect()}
    train = [(i, words(t)) for i, t in rows if remainder(i, 5) != 1]
    count = Counter(w for _, ws in train for w in ws)
    n, v = sum(count.values()) + len(train), len(count) + 1
    kept, kinds = [], sorted({math.floor(8 * math.log2(c)) for c in count.values()}, reverse=True)
    for k in kinds:
        more = [w for w, c in count.items() if math.floor(8 * math.log2(c)) == k]
        if len(kept) + len(more) > 100:
            break
        kept += more
    hashes = {w: int(lm.tokens_of([w])[0][0]) for w in kept}
    kept.sort(key=lambda w: (-count[w], hashes[w]))
    kept = [w for w in kept if count[w] > 1]
    token = {w: k + 1 for k, w in enumerate(kept[:30])}
    sizes = sorted({math.floor(2 * math.log2(count[w])) for w in kept[30:]}, reverse=True)
    token |= {w: 31 + sizes.index(math.floor(2 * math.log2(count[w]))) for w in kept[30:]}
    size = 30 + len(sizes) + 2
    back_ids = {r["doc_id"] for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0).select("doc_id").collect()}
    pairs = np.zeros((2, size, size), dtype=np.float32)
    for i, ws in train:
        flat = [0, *[token.get(w, size - 1) for w in ws], 0]
        for a, b in zip(flat, flat[1:]):
            pairs[int(i in back_ids), a, b] += 1
    scorer = lm.trained(pairs[0], pairs[1], 4, 3)
    mass = Counter()
    for w, c in count.items():
        mass[token.get(w, size - 1)] += c + 0.5
    mass[size - 1] += 0.5
    for i, t in rows:
        ws = words(t)
        flat = [0, *[token.get(w, size - 1) for w in ws], 0]
        want = sum(float(scorer.log10(np.array([a]), np.array([b]))[0]) for a, b in zip(flat, flat[1:]))
        want += sum(math.log10((count[w] + 0.5) / mass[token.get(w, size - 1)]) for w in ws if token.get(w, size - 1) > 30)
        assert abs(got[i] - want) < 1e-3 * max(1, abs(want) / 100)


@pytest.mark.parametrize("known", [0, 3])
def test_lm_words_beyond_the_list_are_joined(spark, known):
    """The list of known words decides the classes of the score, but no count (joined words' scores: the plain version)."""
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(12))) for i in range(30)]
    df = documents(spark, rows)
    keep = ["n_tokens", "n_known", "train_tokens", "base_score"]
    whole = {r["doc_id"]: [r[k] for k in keep] for r in lm.score_texts(df, vocabulary=0, width=4, steps=2, known_words=100).collect()}
    split = {r["doc_id"]: [r[k] for k in keep] for r in lm.score_texts(df, vocabulary=0, width=4, steps=2, known_words=known).collect()}
    assert all(whole[i][:3] == split[i][:3] and abs(whole[i][3] - split[i][3]) < 1e-9 for i in whole)
