"""Small tables and plain versions that the tests of the training-data operators share."""

import random
import re

SF = "/root/testdata/sf0.001"
#: Columns beyond the documents', with names that the operators use inside.
EXTRA = "id long, t string, th long, n long, row long, key string, held boolean, n_lines long, n_dropped long, held_out string, score string, component string, region int, length string"
DOCS = f"doc_id long, text string, lang string, {EXTRA}"


def sentence(rng, n):
    return " ".join(rng.choice("river stone bright window carry seven lamp north quiet table orange letter".split()) + str(rng.randint(0, 99) if rng.random() < 0.3 else "") for _ in range(n))


def edge_texts():
    """(doc_id, text): nulls, empty, blank and very long texts, copies, near copies, shared ids."""
    rng = random.Random(4)
    long = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60_000))
    passage = " ".join(f"passage{rng.randint(0, 10**4)}" for _ in range(90))
    base = sentence(rng, 120).split(" ")
    near = list(base)
    near[7] = "changed"
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, long), (5, long), (6, "one"), (7, "ONE"), (8, "two words"),
        (9, " ".join(base)), (10, " ".join(near)), (11, sentence(rng, 30) + " " + passage), (12, passage + " " + sentence(rng, 25)),
        (13, "ümlaut straße " * 40), (13, "ümlaut straße " * 40), (14, "same id, first text " + sentence(rng, 20)), (14, "same id, second text " + sentence(rng, 20)),
        (None, "a text without an id"), (15, "\x00 null byte \U0001f600 and emoji"), (-3, " ".join(base)), (16, passage + " | " + passage),
    ]
    return rows


def documents(spark, rows):
    filler = (1, "x", 2, 3, 4, "k", True, 7, 8, "h", "s", "c", 5, "l")
    return spark.createDataFrame([(i, t, "en" if t and k % 2 else None, *filler) for k, (i, t) in enumerate(rows)], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def reachable(nodes, links):
    """node -> smallest node reachable."""
    low = {n: n for n in nodes}

    def root(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
