"""Line, n-gram Jaccard and byte-string duplicates against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import jaccard_join, line_templates, suffix_repeats
from tallyfield.llm.common import components, shingle_set

from .helpers import documents, edge_texts, reachable, table, words


# ------------------------------------------------------------------ components


def test_components_of_chains_stars_and_doubles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(7, 7), (8, 9), (9, 8), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    assert got == reachable(nodes, [e for e in edges if None not in e and e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ Jaccard


def brute_jaccard(rows, size=3, part=90, share=100):
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
    held = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for g in s:
            held[g].append(k)
    common = Counter((a, b) for ks in held.values() for x, a in enumerate(ks) for b in ks[x + 1 :])
    links = [
        (sets[a][0], sets[b][0])
        for (a, b), c in common.items()
        if None not in (sets[a][0], sets[b][0]) and share * c >= part * (len(sets[a][1]) + len(sets[b][1]) - c)
    ]
    low = reachable({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), low.get(i)) for i, s in sets), key=str)


def near_copies(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    while len(rows) < n:
        base = [f"v{rng.randint(0, 400)}" for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice([1, 1, 2, 6, 40])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = f"v{rng.randint(0, 400)}"
            rows.append((len(rows), " ".join(t)))
    return rows


def got_groups(df, **kw):
    return sorted((tuple(r) for r in jaccard_join.jaccard_groups(df, **kw).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_jaccard_edges(spark):
    rows = edge_texts()
    assert got_groups(documents(spark, rows)) == brute_jaccard(rows)
    assert got_groups(documents(spark, [])) == []


def test_jaccard_documents(spark):
    docs = table(spark, "documents")
    assert got_groups(docs) == brute_jaccard([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 8}, {"cell_rows": 5, "cell_shingles": 900, "frequent": 20, "open_rows": 0}])
def test_jaccard_near_copies(spark, limits):
    rows = near_copies()
    df = documents(spark, rows)
    assert got_groups(df, words=2, part=80, **limits) == brute_jaccard(rows, 2, 80)


def test_jaccard_rows_that_share_ids_join_what_they_link_with(spark):
    rng = random.Random(12)
    text = lambda: [f"t{rng.randint(0, 10**6)}" for _ in range(80)]
    near = lambda t: " ".join([*t[:40], "changed", *t[41:]])
    a, b, c, d = text(), text(), text(), text()
    rows = [(14, " ".join(a)), (14, " ".join(b)), (20, near(a)), (21, near(b)), (30, near(c)), (14, ""), (9, "x"), (None, " ".join(a))]
    # one id with very many texts, two of which others have too
    rows += [(40, " ".join(text())) for _ in range(30)] + [(40, " ".join(c)), (40, near(d)), (35, " ".join(d))]
    want = brute_jaccard(rows)
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_groups(documents(spark, rows)).collect()}
    assert {(14, 14), (20, 14), (21, 14), (30, 30), (40, 30), (35, 30), (9, 9), (None, None)} == got
    assert got_groups(documents(spark, rows)) == want
    assert got_groups(documents(spark, rows), cell_rows=2) == want


def test_jaccard_a_shingle_that_most_texts_begin_with(spark):
    """A key of more texts than a task may hold: no link is lost, and cells by pivots divide its region."""
    rng = random.Random(13)
    rows = []
    for k in range(150):
        t = "common first words " + " ".join(f"r{rng.randint(0, 10**5)}" for _ in range(60))
        rows += [(3 * k, t), (3 * k + 1, t + " more"), (3 * k + 2, t)]
    assert got_groups(documents(spark, rows), cell_rows=20, frequent=0) == brute_jaccard(rows)


def in_large_regions(monkeypatch):
    """The sets that jaccard_groups hands on to _large_regions, counted."""
    held, real = [], jaccard_join._large_regions
    monkeypatch.setattr(jaccard_join, "_large_regions", lambda sets, *a: (held.append(sets.count()), real(sets, *a))[1])
    return held


@pytest.mark.parametrize("lead", ["shared by all these texts", "the the the the"])
def test_unlike_texts_with_a_common_shingle_make_no_region(spark, monkeypatch, lead):
    """A key of more texts than a task may hold doesn't put texts into one region that have nothing else in common."""
    rng, held = random.Random(15), in_large_regions(monkeypatch)
    rows = [(k, lead + " " + " ".join(f"r{rng.randint(0, 10**6)}" for _ in range(rng.randint(8, 60)))) for k in range(120)]
    rows += [(1000 + k, rows[k][1] + " more") for k in range(3)]
    # few words in common are enough for a link, so most shingles are keys
    assert got_groups(documents(spark, rows), cell_rows=20, frequent=0, part=60) == brute_jaccard(rows, part=60)
    assert held == [0]


def test_crowded_keys_are_dealt_so_that_near_sizes_meet(spark):
    rng = random.Random(16)
    rows = [(k, 1000 * k + i, rng.choice([rng.randint(1, 400), 100, 90]), b"") for k in (1, 2) for i in range(300)]
    got = jaccard_join._dealt(spark.createDataFrame(rows, "key long, id long, n long, sketch binary"), 90, 100, 25).collect()
    held = defaultdict(set)
    for r in got:
        held[r["key"]].add((r["id"], r["n"]))
    assert max(map(len, held.values())) <= 2 * 25 * 1.6  # blocks are dealt by hash
    met = {(a[0], b[0]) for x in held.values() for a in x for b in x}
    assert all((a[1], b[1]) in met for a in rows for b in rows if a[0] == b[0] and 100 * min(a[2], b[2]) >= 90 * max(a[2], b[2]))
    assert all(a // 1000 == b // 1000 for a, b in met)


def test_a_large_region_of_near_copies_is_not_copied_for_each_pivot(spark):
    rng = random.Random(17)
    base = [f"b{k}" for k in range(200)]
    sets = []
    for i in range(300):
        t = list(base)
        for at in rng.sample(range(200), rng.randint(0, 16)):
            t[at] = f"x{rng.randint(0, 10**6)}"
        sets.append((1, i, shingle_set(" ".join(t).encode(), 1).tobytes(), 300, 300 / 60))
    df = spark.createDataFrame(sets, "region long, id long, s binary, held long, load double")
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()

    def written():
        bus.waitUntilEmpty()
        return sum(store.executorList(False).apply(k).totalShuffleWrite() for k in range(store.executorList(False).size()))

    links = jaccard_join._large_regions(df, 90, 100, 60, 10**6, 0)
    start = written()
    links = [(r["a"], r["b"]) for r in links.collect()]
    assert written() - start < 2 * sum(len(s[2]) for s in sets)  # compressed
    got = {frozenset(x) for x in links if x[0] != x[1]}
    want = [set(np.frombuffer(s[2], dtype=np.uint64).tolist()) for s in sets]
    want = [(i, j) for i in range(300) for j in range(i) if 100 * len(want[i] & want[j]) >= 90 * len(want[i] | want[j])]
    assert reachable(range(300), [tuple(x) for x in got]) == reachable(range(300), want)


def test_pivots_divide_a_region_before_anything_is_compared(monkeypatch):
    rng = random.Random(14)
    rows = []
    for k in range(25):
        base = [f"{k}-{rng.randint(0, 50)}" for _ in range(60)] + [f"all{j}" for j in range(20)]
        rows += [(len(rows) + j, " ".join(base[:70] + [f"n{rng.randint(0, 99)}"] + base[70:])) for j in range(10)]
    sets = [shingle_set(t.encode(), 1) for _, t in rows]
    largest = []
    real = np.triu
    monkeypatch.setattr(jaccard_join.np, "triu", lambda m, k: (largest.append(len(m)), real(m, k))[1])
    found = jaccard_join.metric_join(sets, 80, 100)
    assert max(largest, default=0) <= 64 < len(rows)
    assert [int(x) for x in found] == [c for _, _, c in sorted(brute_jaccard(rows, 1, 80))]


def test_metric_join_is_exact_when_it_splits():
    rows = near_copies(300, 9)
    sets = [shingle_set(t.encode(), 3) for _, t in rows]
    found = jaccard_join.metric_join(sets, 80, 100, leaf=10, pivots=4)
    assert [(i, len(s), int(c)) for (i, _), s, c in zip(rows, sets, found)] == sorted(brute_jaccard(rows, 3, 80), key=lambda r: r[0])


# ------------------------------------------------------------------ repeated byte strings


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(t[k : k + length]) for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for k in range(len(t) - length + 1):
            if seen[hash(t[k : k + length])] > 1:
                gone[k : k + length] = True
        left = bytes(np.frombuffer(t, dtype=np.uint8)[~gone[:-1]])
        out.append((i, len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def got_repeats(df, length):
    return sorted((tuple(r) for r in suffix_repeats.repeat_report(df, length=length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("length", [64, 400])
def test_repeats_edges(spark, length):
    rows = edge_texts()
    assert got_repeats(documents(spark, rows), length) == brute_repeats(rows, length)
    assert got_repeats(documents(spark, []), length) == []


def test_repeats_periods_and_planted_passages(spark):
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 300))) for _ in range(12)]
    rows = [(0, "ab" * 300), (1, "x" * 500), (2, "abc" * 90 + "x" * 70), (3, ("".join(rng.choice("ab") for _ in range(40))) * 12)]
    for i in range(4, 80):
        parts = ["".join(rng.choice("ijklmnop ") for _ in range(rng.randint(0, 120))) for _ in range(3)]
        rows.append((i, parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages)[rng.randint(0, 30) :] + parts[2]))
    assert got_repeats(documents(spark, rows), 64) == brute_repeats(rows, 64)


def test_repeats_documents(spark):
    docs = table(spark, "documents")
    assert got_repeats(docs, 400) == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()], 400)


@pytest.mark.parametrize("few", [20_000, 1])
def test_repeats_of_crowded_groups_and_passages(spark, monkeypatch, few):
    """Crowded groups are opened; passages too short to be removed are reported, and nothing else is."""
    monkeypatch.setattr(suffix_repeats, "MEMBERS", few)
    rng = random.Random(18)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(330, 600))) for _ in range(9)]
    own = lambda n: "".join(rng.choice("ijklmnop ") for _ in range(n))
    rows = [(0, passages[0] * 2), (1, None), (2, passages[1]), (3, passages[1]), (None, passages[2][:150]), (4, "y" * 300)]
    rows += [(i, own(rng.randint(200, 900)) + passages[i % 9][: 330 if i % 2 else 600] + own(rng.randint(200, 900))) for i in range(5, 70)]
    rows += [(i, own(900)) for i in range(70, 90)]
    out = suffix_repeats.repeat_report(documents(spark, rows)).collect()
    assert sorted((tuple(r[:5]) for r in out), key=str) == brute_repeats(rows, 400)
    held = {r["doc_id"]: r for r in out}
    assert all(held[i]["has_passage"] and held[i]["n_passage_bytes"] >= 120 for i in range(5, 70))
    assert all(not held[i]["has_passage"] and held[i]["n_passage_bytes"] == 0 for i in [1, *range(70, 90)])


def test_removing_repeats_keeps_columns_and_nulls(spark):
    rows = edge_texts()
    df = documents(spark, rows)
    out = suffix_repeats.remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (1, None) in texts and (2, "") in texts and (4, "") in texts and (8, "two words") in texts
    clashing = df.withColumns({c: F.lit(9) for c in ("_key", "_hash", "_starts", "_ends", "_id", "_th", "a.b")})
    assert suffix_repeats.remove_repeats(clashing).where("_id = 9 and _th = 9 and _key = 9 and _hash = 9 and _starts = 9 and `a.b` = 9").count() == len(rows)
    with pytest.raises(ValueError):
        suffix_repeats.remove_repeats(df, length=20)


# ------------------------------------------------------------------ recurring lines


def brute_lines(rows, min_docs=5, min_tokens=4, depth=3, similarity=0.7):
    def tokens_of(line):
        return tuple("0" if any(c in "0123456789" for c in t) else t for t in line.encode().split() for t in [t.decode()])

    docs = list(dict.fromkeys((i if i is not None else -(1 << 63), t) for i, t in rows))
    count = Counter()
    for _, t in rows:
        count.update({x for line in (t or "").split("\n") if len(x := tokens_of(line)) >= min_tokens})
    template = {}

    def grow(held, level):
        """Templates of one leaf's lines; those that don't fit divide by the place with the fewest tokens."""
        total = sum(count[x] for x in held)
        if total < min_docs:
            return
        size, kept, kinds = len(held[0]), [], []
        for p in range(size):
            at = Counter()
            for x in held:
                at[x[p]] += count[x]
            n, token = max((n, token.encode()) for token, n in at.items())
            kept.append(token.decode() if 2 * n >= total else "0")
            kinds.append((len(at), p))
        away = defaultdict(list)
        place = min((k for k in kinds if k[0] > 1 and k[1] >= depth), default=(0, 0))[1]
        for x in held:
            t = tuple(a if p < depth or a == kept[p] else "0" for p, a in enumerate(x))
            if size - (t.count("0") - x.count("0")) >= similarity * size and 2 * t.count("0") <= size:
                template[x] = t
            else:
                away[x[place]].append(x)
        for more in away.values():
            if level < 2:
                grow(more, level + 1)
            else:
                template.update({x: x for x in more if 2 * x.count("0") <= size})

    leaves = defaultdict(list)
    for tokens in count:
        leaves[(len(tokens), tokens[:depth])].append(tokens)
    for held in leaves.values():
        grow(held, 0)
    where = defaultdict(list)
    for d, (i, t) in enumerate(docs):
        for k, line in enumerate((t or "").split("\n")):
            if tokens_of(line) in template:
                where[template[tokens_of(line)]].append((i, d, k))
    gone = defaultdict(set)
    for spots in where.values():
        if len({d for _, d, _ in spots}) >= min_docs:
            first = min(spots, key=lambda s: (s[0], s[2]))
            for i, d, k in spots:
                if (i, d, k) != first:
                    gone[docs[d]].add(k)
    out = []
    for i, t in rows:
        g = gone[(i if i is not None else -(1 << 63), t)]
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g), 0 if t is None else len(t.split("\n")), len(g)))
    return sorted(out, key=str)


def got_lines(df, **kw):
    return sorted((tuple(r) for r in line_templates.drop_recurring_lines(df, **kw).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def test_lines_planted(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        own = [" ".join(f"{rng.choice('abcdefg')}{rng.choice('hijklmn')}word" for _ in range(rng.randint(1, 9))) for _ in range(4)]
        own.insert(rng.randint(0, 4), f"Page {i} of 60 printed on day {rng.randint(1, 30)} by the office")
        if i % 3 == 0:
            own.append(f"All rights reserved by the company named {['North', 'South', 'West'][i // 3 % 3]} today")
        if i % 20 == 0:
            own.append("Rare line of only three documents here")
        rows.append((i, "\n".join(own)))
    want = brute_lines(rows)
    assert got_lines(documents(spark, rows)) == want
    assert sum(r[3] for r in want) == 59 + 19


@pytest.mark.parametrize("docs", [40, 100, 900, 9000])
def test_fields_stay_fields_at_every_size(spark, docs):
    """A field's values recur ever more often as the corpus grows, and the line stays one template."""
    rng = random.Random(docs)
    name = lambda k, n: "".join(chr(97 + (k * n + j * j) % 23) for j in range(4)) + chr(97 + k % 26)
    rows = [(i, f"Session opened for {name(rng.randrange(30), 7)} at the main site of {name(rng.randrange(30), 11)} today") for i in range(docs)]
    # other templates with the same leading tokens, and lines that nothing else resembles
    rows += [(10**5 + i, f"Session opened for {name(i % 30, 7)} but the old door of {name(i % 7, 5)} stuck") for i in range(docs // 4)]
    rows += [(10**6 + i, "Session opened for " + " ".join(name(rng.randrange(10**4), 3) + name(rng.randrange(10**4), 9) for _ in range(8))) for i in range(20)]
    got = got_lines(documents(spark, rows))
    kept = [r for r in got if r[1]]
    assert sum(r[0] < 10**5 for r in kept) == 1
    assert sum(10**5 <= r[0] < 10**6 for r in kept) == 1
    assert sum(r[0] >= 10**6 for r in kept) == 20
    if docs <= 900:
        assert got == brute_lines(rows)


def test_literal_marks_are_tokens_like_others(spark):
    rows = [(i, f"kinds of marks {x} in a line") for i, x in enumerate(["<*>"] * 5 + ["word"] * 4)]
    assert got_lines(documents(spark, rows)) == brute_lines(rows)


def test_one_document_fixes_no_token(spark):
    line = "Session opened for {} at the main site today"
    rows = [(0, "\n".join([line.format("anna")] * 500))] + [(i, line.format("bcdefghijk"[i] * 3)) for i in range(1, 9)]
    got = got_lines(documents(spark, rows))
    assert got == brute_lines(rows) and sum(r[3] for r in got) == 507


def test_lines_edges(spark):
    rows = edge_texts() + [(100 + k, "Cookie notice: accept all\n\nsomething own here") for k in range(6)] + [(100, "Cookie notice: accept all\n\nsomething own here")]
    df = documents(spark, rows)
    assert got_lines(df) == brute_lines(rows)
    assert got_lines(documents(spark, [])) == []
    out = line_templates.drop_recurring_lines(df)
    assert set(out.columns) == set(df.columns)


def test_lines_documents(spark):
    docs = table(spark, "documents")
    assert got_lines(docs) == brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()])


def varied_lines(seed=5):
    """A leaf of many lines: templates that vary in the last, the second-last and other tokens."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    bases = [[word() for _ in range(9)] for _ in range(40)]
    rows = []
    for i in range(300):
        lines = []
        for _ in range(3):
            tokens = list(rng.choice(bases))
            for p in rng.choice([[8], [7], [7, 8], [3, 8], [2, 4, 6]]):
                tokens[p] = word()
            lines.append("one two three " + " ".join(tokens))
        rows.append((i, "\n".join(lines)))
    return rows


def test_lines_of_a_large_leaf(spark):
    rows = varied_lines()
    want = brute_lines(rows)
    assert sum(r[3] for r in want) > 500
    assert got_lines(documents(spark, rows)) == want


def test_lines_with_clashing_names(spark):
    rows = [(i, "a line of several documents here\nown") for i in range(6)]
    clash = documents(spark, rows).withColumns({c: F.lit(4) for c in ("_gone", "_lost", "_key", "_hash", "_id", "_th", "a.b")})
    out = line_templates.drop_recurring_lines(clash)
    assert out.where("_gone = 4 and _lost = 4 and _key = 4 and `a.b` = 4 and n_dropped = 1").count() == 5


def test_short_lines_recur_as_equals(spark, tmp_path):
    shared = ["All rights reserved.", "Contents", "\u5168\u6587\u4e0d\u5f97\u8f6c\u8f7d", "page 3 of"]
    rows = [(i, "\n".join(["", "own%s" % "abcdefgh"[i], *shared[: 3 if i < 2 else 4], f"{i}", "  "]).replace("page 3", f"page {i}")) for i in range(7)]
    rows += [(20 + i, f"All rights {x}") for i, x in enumerate(["remain", "lapse", "end", "return"])]
    held = {r["doc_id"]: (r["text"].split("\n"), r["n_dropped"]) for r in line_templates.drop_recurring_lines(documents(spark, rows), short_lines=True).collect()}
    assert held[0] == (["", "owna", *shared[:3], "0", "  "], 0)
    assert held[1] == (["", "ownb", "1", "  "], 3)
    assert held[2] == (["", "ownc", "page 2 of", "2", "  "], 3)
    assert held[3] == (["", "ownd", "3", "  "], 4)
    assert all(held[20 + k][1] == 0 for k in range(4))
    # the query and the pipeline's stage include them
    import corpus_pipeline
    from tallyfield.llm import registry

    df = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert sum(r["n_dropped"] for r in registry.op1_line_templates(spark, str(tmp_path)).collect()) == 3 * 6 + 4
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_recurring_lines(spark, df, "").collect()}
    assert left[6] == "\nowng\n6\n  "
