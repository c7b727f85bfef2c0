"""Stages of the corpus pipeline against plain expectations."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfield.llm.language import Profiles

from .helpers import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", 0 if t is None else len(t)) for i, t in rows], DOCS)


def test_language_stage_drops_what_resembles_no_language(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 12))) for _ in range(300)) for _ in range(5)]
    noise += ["xkcd qqq zzz " * 40, "\u0391\u0392\u0393 \u03b4\u03b5\u03b6 \u03b7\u03b8\u03b9 " * 40]
    docs = table(spark, "documents").select(*corpus_pipeline.COLUMNS)
    planted = made(spark, [(10**7 + k, t) for k, t in enumerate(noise)] + [(10**7 + 90, "12 34"), (10**7 + 91, None)]).withColumn("lang", F.lit(None).cast("string"))
    left = {r["doc_id"] for r in corpus_pipeline.keep_known_languages(spark, docs.union(planted), "").select("doc_id").collect()}
    assert not {i for i in left if i >= 10**7}
    clean = {r["doc_id"] for r in docs.where("n_chars >= 100").select("doc_id").collect()}
    assert clean <= left


def test_repeated_rows_and_null_ids_leave_one_row_of_each_group(spark, tmp_path):
    rng = random.Random(2)
    text = lambda n=120: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    same, own, near, two, others = text(), text(), text().split(" "), [text(), text()], [text(), text()]
    changed = " ".join([*near[:60], "changed", *near[61:]])
    near = " ".join(near)
    rows = [(1, same), (1, same), (1, same), (2, own), (None, others[0]), (None, others[1]), (None, others[1])]
    rows += [(4, changed), (3, near), (None, near), (5, two[0]), (5, two[1]), (6, two[0]), (7, "\t"), (7, "\t"), (8, "\t"), (9, None), (9, None)]
    want = [(1, same), (2, own), (3, near), (5, two[0]), (5, two[1]), (7, "\t"), (8, "\t"), (9, None), (None, others[0]), (None, others[1])]
    out = corpus_pipeline.keep_one_of_each_group(spark, made(spark, rows), "")
    assert out.columns == corpus_pipeline.COLUMNS
    out.write.parquet(str(tmp_path / "kept"))
    out = spark.read.parquet(str(tmp_path / "kept"))
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    # none of them is a copy any more, so the next stage takes nothing away
    left = corpus_pipeline.drop_repeated_strings(spark, out, "")
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted((w for w in want if w[1] is not None), key=str)


def test_letters_of_every_script_have_their_own_vectors():
    cyrillic = [chr(c) for c in range(0x430, 0x450)]
    x = Profiles().bundle([*(c * 3 for c in cyrillic), "\U00010428\U00010429", "\u0414\u0410", "\u0434\u0430", "12"])
    alike = x[:32] @ x[:32].T - np.eye(32)
    assert alike.max() < 0.9
    assert np.abs(x[32]).sum() > 0 and not x[35].any()
    assert np.allclose(x[33], x[34])


def test_stages_on_odd_rows(spark):
    """Nulls, empty and blank texts, repeated rows, shared and null ids, extra columns with names used inside."""
    en = "the river of the stone and the bright window that carries seven lamps to the quiet north table"
    line = "All rights of this page are kept by the owner"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, en), (4, en), (5, en + " again"), (None, en + " once more"), (6, "12 34"), (5, "another text of the same id " + en)]
    rows += [(10 + k, f"{en} number {k}\n{line}") for k in range(6)]
    extra = {c: F.lit(1) for c in ("id", "t", "th", "lang_pred", "score", "held_out", "n_lines", "n_dropped", "_row", "key")}
    docs = made(spark, rows).withColumns(extra)
    kept = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted((i or 0, t) for i, t in rows if t and any(c.isalpha() for c in t))
    left = corpus_pipeline.drop_recurring_lines(spark, docs, "")
    assert left.columns == corpus_pipeline.COLUMNS
    got = left.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    # both lines of the last six recur as templates and stay in the first of them alone
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted((i or 0, t) for i, t in rows if t and t.strip(" ") and i not in range(11, 16))
    packed = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    assert sorted(r["doc_id"] or 0 for r in packed if r["piece"] == 0) == sorted(i or 0 for i, _ in rows)
    for stage in (corpus_pipeline.keep_known_languages, corpus_pipeline.drop_recurring_lines, corpus_pipeline.pack_sequences):
        assert stage(spark, docs.limit(0), "").count() == 0
