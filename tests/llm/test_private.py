"""Personal data against the patterns as regular expressions, and the random field on held-out texts."""

import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import private_spans as P
from tallyfield.llm import registry

from .helpers import SF, documents, edge_texts, table

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def passes(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == 1:
        return all(int(x) <= 255 for x in s.split("."))
    if kind == 2:
        doubled = [d * 2 if k % 2 else d for k, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == 0 or 10 <= len(digits) <= 15


def plain(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(k, m.group()))


MORE = [
    "a@b.c_d@e.f x@y@z.com. a@b-.c. .@-.- @a.b a@.b", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255 1.2.3 0000000255.1.1.1", "4111111111111111 4111 1111-1111 1111 41111111111111112 4111  111111111111",
    "+1 (499) 555-6503 +49.30.1234567- +1 +12 + 1234567890 +1234567890123456", "+1 (826) 555-4081 190.137.223.204", "٤١١١ +٤٩ é@x.de \U0001f600 a@b.de", "user@host.example,4111111111111111;10.0.0.1",
]


def found_in(df):
    out = P.find_private(df)
    return [(r["doc_id"], r["text"], [(s["start"], P.KINDS.index(s["kind"]), s["end"], s["base"]) for s in r["private"]]) for r in out.select("doc_id", "text", "private").collect()]


def test_patterns_equal_the_regular_expressions():
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("ab1239 .-+@()_%5\n"), 60)) for _ in range(4000)]
    for t in [*MORE, *made, *[t for _, t in edge_texts() if t and len(t) < 10**5]]:
        assert P.base_spans(t) == plain(t), t
    # long runs are read a few times, not once from every place
    for t in ("1" * 10**6, "a." * 10**6, "1.1." * 10**5, "+1" * 10**5, "a@" * 10**5, "a@b" * 10**5):
        P.base_spans(t)


def test_zones_are_apart_and_hold_all_that_can_be_found():
    rng = np.random.default_rng(2)
    for _ in range(300):
        parts = [["call 030 1234567", "x (at) y.org", "12", "word " * 9, "\n", "a@b.org", "4111 1111 1111 1111"][k] for k in rng.integers(0, 7, 12)]
        t = " ".join(parts)
        base = P.base_spans(t)
        held = P.zones(t, base)
        assert all(a < b for a, b in held) and all(x[1] <= y[0] for x, y in zip(held, held[1:]))
        assert not any(a < y and x < b for a, b in held for x, _, y in base)
        whole = P.Zone(t)
        for s in whole.segments:
            a, b = whole.span(s)
            if not any(a < y and x < b for x, _, y in base) and "\n" not in t[a:b]:
                assert any(x <= a and b <= y for x, y in held), (t, t[a:b])


def test_sums_over_segmentations_are_exact():
    """Forward sums, best paths and the gradient of a small zone against all of its segmentations."""
    text = "tel 1234567 (89) 12345678"
    zone = P.Zone(text)
    n, rng = len(zone.tokens), np.random.default_rng(3)
    field = P.fit_field([(text, [(4, 3, 11)])], rounds=1, least=1)
    field.weights, field.adjacent = rng.standard_normal(field.weights.shape), -0.7
    scores = field.scores(zone)
    every = []
    choices = [(i, j, k, scores[k, c]) for c, (i, j) in enumerate(zone.segments) for k in range(4)]
    for size in range(0, 4):
        for some in itertools.combinations(choices, size):
            marks = sorted(some)
            if all(x[1] <= y[0] for x, y in zip(marks, marks[1:])):
                every.append((sum(x[3] for x in marks) + field.adjacent * sum(x[1] == y[0] for x, y in zip(marks, marks[1:])), marks))
    ends = {}
    for c, (i, j) in enumerate(zone.segments):
        ends.setdefault(j, []).append((c, i))
    total = np.log(np.exp(scores).sum(axis=0))
    out, ent = P.chains(ends, total, field.adjacent, n)
    assert P.log_add(out[n], ent[n]) == pytest.approx(math.log(sum(math.exp(s) for s, _ in every)))
    best = max(every, key=lambda x: x[0])[1]
    assert field.best(text) == [(zone.span((i, j))[0], k, zone.span((i, j))[1]) for i, j, k, _ in best]


def test_training_raises_the_likelihood():
    text, other = "tel 0301234567 now", "sum 0301234567 now"
    field = P.fit_field([(text, [(4, 3, 14)]), (other, [])] * 5, least=1)
    assert field.best(text) == [(4, 3, 14)] and field.best(other) == []


def test_held_out_texts():
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist() if t]

    def cut(held):
        out = []
        for t in held:
            spans = P.base_spans(t)
            for low, high in P.zones(t, []):
                inside = [(a - low, k, b - low) for a, k, b in spans if low <= a and b <= high]
                if P.apart(inside):
                    out.append((t[low:high], inside))
        return out

    field = P.fit_field(P.examples_of(cut(texts[::2])[:600]))
    for zones, least in ((cut(texts[1::2]), 0.97), (P.examples_of(cut(texts[1::2])[:300], seed=5), 0.95)):
        got = [(set(field.best(t)), set(w)) for t, w in zones]
        right, said, wanted = (sum(map(len, x)) for x in ([g & w for g, w in got], [g for g, _ in got], [w for _, w in got]))
        assert wanted > 100 and right >= least * wanted and right >= least * said
    clean = [t for t in texts if not re.search(r"[0-9@]", t)]
    assert clean and not any(P.all_spans(t, field)[1] for t in clean)


def test_edges(spark):
    rows = edge_texts() + [(40 + k, t) for k, t in enumerate(MORE)]
    df = documents(spark, rows).withColumn("private", F.lit(3)).withColumn("start", F.lit("s"))
    out = P.find_private(df)
    assert out.columns == [*[c for c in df.columns if c != "private"], "private"]
    got = found_in(df)
    assert sorted((i, t) for i, t, _ in got if i is not None) == sorted((i, t) for i, t in rows if i is not None) if all(t is not None for _, t in rows) else len(got) == len(rows)
    for _, t, spans in got:
        assert [s[:3] for s in spans if s[3]] == plain(t)
        assert spans == sorted(spans)
        added = [s for s in spans if not s[3]]
        assert not any(a[0] < b[2] and b[0] < a[2] for a in added for b in spans if a is not b)
    assert found_in(documents(spark, [])) == []
    assert found_in(documents(spark, [(1, None), (2, ""), (3, "no such data")])) == [(1, None, []), (2, "", []), (3, "no such data", [])]


def test_query(spark):
    got = {r["doc_id"]: r for r in registry.queries()["op11_span_field"](spark, SF).collect()}
    rows = table(spark, "documents").collect()
    assert len(got) == len({r["doc_id"] for r in rows})
    for r in rows:
        want, held = plain(r["text"]), got[r["doc_id"]]
        said = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert held["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [held[f"n_{k}"] for k in P.KINDS] == [sum(x[1] == n for x in want) for n in range(4)]
        assert set(filter(None, said.split(","))) <= set(held["spans"].split(","))
