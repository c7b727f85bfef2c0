"""Encoding, counting and packing of tokens, and the pipeline, against plain versions."""

import itertools
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyfield.llm import packing, pieces, registry, token_scan
from tallyfield.session import ship_package

from .helpers import SF, documents, edge_texts, table

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    tokenizers = pytest.importorskip("tokenizers")
    held = ids_of.__dict__.setdefault("held", tokenizers.Tokenizer.from_file(BPE))
    return held.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ SentencePiece


def test_pieces_are_the_models_own(spark):
    """The ids of every document, and of random texts, are those of the library."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    held = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)
    docs = table(spark, "documents")
    want = {r["doc_id"]: held.encode(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in pieces.encode_pieces(docs, path).collect()} == want
    model = pieces.PieceModel(path)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("aaabcdeehinorstthe   \u00fc\u65e5\t\n.,\U0001f6001①") for _ in range(rng.randint(0, 24)))
        assert model.encode(text).tolist() == held.encode(text)


def test_pieces_round_trip(spark):
    rows = edge_texts() + [(60, "literal ▁ mark  and  spaces "), (61, " leading"), (62, "tab\tline\nend")]
    encoded = pieces.encode_pieces(documents(spark, rows), public_tokenizers.path("piece_bpe_32k.model"))
    back = pieces.decode_pieces(encoded, public_tokenizers.path("piece_bpe_32k.model"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((i, t or "") for i, t in rows)
    assert pieces.encode_pieces(documents(spark, []), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


# ------------------------------------------------------------------ token files


def test_separator_scan_of_any_blocks(spark):
    rng = np.random.default_rng(3)
    rows, want = [], []
    for file in range(12):
        lengths = rng.integers(0, 40, rng.integers(0, 30)).tolist()
        open_end = file % 3 == 0 and bool(lengths) and lengths[-1] > 0
        flat = np.concatenate([np.append(rng.integers(0, 9, n), 9) for n in lengths]) if lengths else np.empty(0)
        flat = (flat[:-1] if open_end else flat).astype("<u2")
        want += [(file, k, n) for k, n in enumerate(lengths)]
        at, block = 0, 0
        while at < len(flat):
            step = int(rng.integers(1, 25))
            rows.append((file, block, bytearray(flat[at : at + step].tobytes()), "x"))
            at, block = at + step, block + 1
        rows.append((file, block, None, "x"))
    blocks = spark.createDataFrame(rows, "file long, block long, data binary, number string")
    got = sorted(tuple(r) for r in token_scan.count_tokens(blocks, 9).select("file", "number", "n_tokens").collect())
    assert got == want
    assert token_scan.count_tokens(blocks.limit(0), 9).count() == 0


def test_token_files_count_every_document(spark, tmp_path):
    rows = edge_texts()
    path = str(tmp_path / "tokens")
    token_scan.write_token_blocks(documents(spark, rows), path, BPE, block_tokens=1000)
    held = spark.read.schema("file long, number long, doc_id long, data binary, kind int").parquet(path)
    counts = token_scan.count_tokens(held.where("kind = 0").selectExpr("file", "number as block", "data"), 50256)
    got = held.where("kind = 1").select("file", "number", "doc_id").join(counts, ["file", "number"])
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == Counter((i, len(ids_of(t))) for i, t in rows)


# ------------------------------------------------------------------ packing


def check_packing(rows, got, capacity=1024):
    """All pieces of all documents are there, gapless, and in close to the fewest sequences."""
    want = Counter()
    for i, t in rows:
        ids = np.array([*ids_of(t), 2], dtype="<u4")
        first = len(ids) % capacity or capacity
        at, k = 0, 0
        while at < len(ids):
            end = at + (first if k == 0 else capacity)
            want[(i, k, at, end - at, zlib.crc32(ids[at:end].tobytes()))] += 1
            at, k = end, k + 1
    assert Counter(tuple(r[:5]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r[3] for r in got)
    return len(sequences), -(-total // capacity)


def packed(df, **kw):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return [tuple(r) for r in packing.pack(df, BPE, **kw).select(*columns).collect()]


def test_packing_edges(spark):
    rows = edge_texts()
    used, least = check_packing(rows, packed(documents(spark, rows)))
    assert used <= least + 1
    used, least = check_packing(rows, packed(documents(spark, rows), capacity=7, bucket_rows=100), 7)
    assert used <= 1.01 * least + 1
    assert packed(documents(spark, [])) == []


def test_packing_documents(spark):
    df = table(spark, "documents")
    used, least = check_packing([(r["doc_id"], r["text"]) for r in df.collect()], packed(df))
    assert used <= 1.01 * least + 1


def test_index_of_sums_finds_what_a_search_of_all_combinations_finds():
    """Single lengths, then pairs, then triples, each with the largest members first, while the stock falls."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        counts = np.zeros(31, dtype=np.int64)
        np.add.at(counts, rng.integers(1, 31, 40), 1)
        stock, left = packing.Sums(counts, 30), Counter({l: int(n) for l, n in enumerate(counts) if n})
        for _ in range(60):
            present = [l for l in left if left[l]]
            if not present:
                break
            head, gap = int(rng.choice(present)), int(rng.integers(1, 31))
            fits = lambda c: not Counter((head, *c)) - left  # noqa: E731,B023
            want = None
            for size in (1, 2, 3):
                combos = sorted((tuple(sorted(c, reverse=True)) for c in itertools.combinations_with_replacement(present, size) if sum(c) == gap), reverse=True)
                want = want or next((c for c in combos if fits(c)), None)
            assert stock.filling(gap, (head,)) == want
            used = (head, *(want or ()))
            stock.use(used, 1)
            left -= Counter(used)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    counts = np.zeros(101, dtype=np.int64)
    np.add.at(counts, rng.integers(1, 101, 3000), 1)
    left = counts.copy()
    for times, lengths in packing.plan(counts, 100):
        assert sum(lengths) <= 100
        for l in lengths:
            left[l] -= times
    assert not left.any()


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{registry.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        before = docs
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() <= rows
            rows = docs.count()
    assert rows > 50
    used, least = check_packing([(r["doc_id"], r["text"]) for r in before.collect()], [tuple(r) for r in docs.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()])
    assert used <= 1.02 * least + 1


def test_every_operator_is_registered():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


def test_merging_stops_at_a_border_and_words_are_kept_as_bytes():
    """op3: a pair of pieces was merged to the end, and a word's ids were a list of its own."""
    model = pieces.PieceModel(registry.tokenizer_path("piece_bpe_32k.model"))
    whole = model.merged("something")
    assert "".join(whole) == "something"
    for at in range(1, len("something")):
        one, two = "something"[:at], "something"[at:]
        stops = model.merged("something", at)
        ends = list(itertools.accumulate(map(len, whole)))
        assert (stops == whole) if at in ends else stops is None, (one, two)
    ids = model.encode("some words and some more")
    assert np.array_equal(model.encode("some words and some more"), ids) and all(isinstance(x, bytes) for x in model.cache.values())
