"""Token alignment against a plain version that compares all byte ranges."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyfield.llm import alignment

from .helpers import documents, edge_texts, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet():
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, more = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(more)] = b
            more += 1
    return out


def plain(rows):
    """Every row's result, by the libraries' own ids and by comparing every two byte ranges of a group."""
    one, alphabet = Tokenizer.from_file(A), byte_alphabet()
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    whole = []
    for doc, t in rows:
        groups, links = [], []
        if t:
            e = one.encode(" " + t, add_special_tokens=False)
            a = [(i, bytes(alphabet[c] for c in x)) for i, x in zip(e.ids, e.tokens)]
            b = []
            for i in two.encode(t):
                p = two.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == (" " + t).encode() == b"".join(x for _, x in b):
                ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
                i = j = 0
                for c in sorted(set(ends[0]) & set(ends[1])):
                    left, right = [], []
                    while i < len(a) and ends[0][i] <= c:
                        left.append((ends[0][i] - len(a[i][1]), ends[0][i], a[i][0]))
                        i += 1
                    while j < len(b) and ends[1][j] <= c:
                        right.append((ends[1][j] - len(b[j][1]), ends[1][j], b[j][0]))
                        j += 1
                    groups.append(([x[2] for x in left], [x[2] for x in right]))
                    links += [(x[2], y[2]) for x in left for y in right if max(x[0], y[0]) < min(x[1], y[1])]
        whole.append((doc, groups, links))
    counts = Counter(p for _, _, links in whole for p in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc, groups, links in whole:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), text,
        ))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in alignment.align_tokens(df, A, B, **kw).collect()), key=str)


MORE = [
    (20, "a <|endoftext|> and <s> </s> <unk> <0x41> inside"), (21, "a literal ▁ mark"), (22, " leading and trailing  "),
    (23, "tabs\tand\r\nlines\n\n\n"), (24, "日本語 க் é \U0001f469‍\U0001f680"), (25, "ﬁ Å Ａ   　"), (26, "x" * 3000),
]


def test_edges(spark):
    rows = edge_texts() + MORE
    want = plain(rows)
    df = documents(spark, rows)
    assert got(df) == want
    hashed = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want]
    assert got(df, keep_groups=False, buckets=1) == sorted(hashed, key=str)
    assert got(documents(spark, [])) == []
    assert got(documents(spark, [(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    with pytest.raises(ValueError):
        alignment.align_tokens(df, A, B, buckets=3)


def test_steps_and_ranges_change_nothing(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(x for _, x in edge_texts() + MORE)]
    want = plain(rows)
    sizes = [np.array([len(x) for x in held]) for held in (alignment.byte_tokens(A)[1], alignment.piece_bytes(B)[1])]
    events = alignment.end_events(spark.createDataFrame([(k, k, t) for k, t in rows], "row long, id long, t string"), A, B).toPandas()
    import pyarrow as pa

    for step in (1, 7, 1000):
        monkeypatch.setattr(alignment, "STEP", step)
        # every end in a row of its own, in batches of 50 rows
        small = []
        for r in events.itertuples(index=False):
            ids = np.frombuffer(r.ids, dtype="<u2")
            ends = np.cumsum(sizes[r.side][ids]) if r.side < 2 else []
            small += [(r.row, r.id, int(e), r.side, ids[k : k + 1].tobytes()) for k, e in enumerate(ends)] or [(r.row, r.id, 0, 2, b"")]
        # ranges of one document meet by offset: its own ends are told apart by what came before
        base = Counter()
        for k, (row, i, e, side, ids) in enumerate(small):
            base[row, side] += int(sizes[side][np.frombuffer(ids, dtype="<u2")[0]]) if side < 2 else 0
            small[k] = (row, i, base[row, side], side, ids)
        small.sort(key=lambda r: (r[0], r[2], r[3]))
        if step == 1:
            small = [r for r in small if r[0] not in (3, 4)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*small[k : k + 50])], names=["row", "id", "at", "side", "ids"]) for k in range(0, len(small), 50)]
        found = {}
        for (docs, counts, groups), _ in alignment.Sweep(sizes, 4, True).run(batches):
            found.update({d: (*c.tolist(), g) for (_, d), c, g in zip(docs, counts, groups)})
        assert all(found[r[0]] == (*r[1:5], r[7]) for r in want if r[0] in found) and len(found) == len({r[0] for r in small})


def test_documents(spark):
    df = table(spark, "documents")
    assert got(df, bucket_docs=60) == plain([(r["doc_id"], r["text"]) for r in df.collect()])


def test_words_have_the_ids_that_the_model_gives_their_texts():
    import public_tokenizers

    from tallyfield.llm.alignment import piece_bytes, word_pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    odd = ["a", " ", "  two  spaces   and more ", "▁ literal ▁mark", "line\nbreak\ttab", "üß漢字 \U0001f600\U0001f600", "x" * 200 + " " + "y" * 60, "<s> </s> <unk> <0x41>", "\x00 \x7f", None, ""]
    texts = odd + [" ".join(odd[:9])] * 2
    model, pieces = piece_bytes(path)[0], word_pieces(path)
    for _ in range(2):  # words found now, then words kept
        assert [x.tolist() for x in pieces(texts)] == [model.encode(t) if t else [] for t in texts]
    assert all(len(w) <= 48 for w in pieces.known)
