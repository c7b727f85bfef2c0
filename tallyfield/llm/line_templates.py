"""Dropping lines whose template recurs across documents, by a fixed-depth log-template tree."""

from __future__ import annotations

import functools
import re
from collections import Counter

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, named, release, saved, sieve, sifted, slices
from .suffix_repeats import NONE, keyed_rows

#: Stands for a token with a digit, or another that varies. A literal "0" in a text has a digit itself, so nothing
#: but a field looks like this.
FIELD = b"0"
_digit = re.compile(rb"[0-9]")


def masked(line: bytes) -> list[bytes]:
    """The tokens of a line, those with a digit as variable fields."""
    tokens = line.split()
    if _digit.search(line):
        tokens = [FIELD if _digit.search(t) else t for t in tokens]
    return tokens


def _hash(*parts: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(b"\x00".join(parts)), "little", signed=True)


def _pair(x: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(x)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def leaf_of(tokens: list[bytes], depth: int) -> int:
    """The tree's leaf: a level for the number of tokens, then one for each leading token."""
    return _hash(str(len(tokens)).encode(), *tokens[:depth])


#: Levels of the tree by a place's value, below the leading tokens.
LEVELS = 2


def _skeletons(lines: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """(leaf, kept, place): what the lines of a leaf have in common. In each place behind the leading tokens the token
    that half of the leaf's documents or more have there is kept, else it is a field; ``place`` is the one with
    the fewest different tokens, but more than one. Leaves of fewer than ``min_docs`` documents are left out."""
    words = lines.select("leaf", "n", F.posexplode("t").alias("pos", "token")).where(F.col("pos") >= depth)
    counts = words.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("k"))
    places = counts.groupBy("leaf", "pos").agg(F.max(F.struct("k", "token")).alias("top"), F.sum("k").alias("total"), F.count(F.lit(1)).alias("kinds"))
    kept = F.when(2 * F.col("top.k") >= F.col("total"), F.col("top.token")).otherwise(FIELD.decode())
    several = F.min(F.when(F.col("kinds") > 1, F.struct("kinds", "pos")))
    held = places.where(F.col("total") >= min_docs).groupBy("leaf")
    return held.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", kept.alias("x")))), lambda x: x["x"]).alias("kept"), several["pos"].alias("place"))


def leaf_templates(distinct: DataFrame, min_docs: int, min_tokens: int, depth: int, similarity: float) -> DataFrame:
    """(t1, t2, l1, l2): the template of each distinct line (leaf, l1, l2, tokens string, n documents) that has one.

    Below the leading tokens, the tokens that half of a leaf's documents share are kept and all other
    places are variable fields: whatever values a field takes, and however often each of them recurs, it
    stays a field, so a larger corpus of the same lines has the same templates. A line that agrees with
    this to a share of ``similarity`` of its tokens, and has no more fields than other tokens, has that template. The
    others go one level down the tree, to a leaf for each token in the place with the fewest different ones,
    and are looked at again; after ``LEVELS`` levels a line is its own template, so equal lines still recur.
    All of this rests on counts: no order of lines matters, and no leaf, token or template has to lie in one task.
    """
    field = F.lit(FIELD.decode())
    open_ = lambda x: F.size(F.filter(x, lambda t: t == field))
    spelling = F.concat_ws(" ", "t")
    out = lambda rows: rows.where(2 * open_(F.col("t")) <= F.size("t")).select(F.xxhash64(spelling).alias("t1"), F.xxhash64(F.lit(1), spelling).alias("t2"), "l1", "l2")
    lines = distinct.select("leaf", "l1", "l2", "n", F.split("tokens", " ").alias("t"))
    short = (F.size("t") < min_tokens) | (F.size("t") <= depth)
    found, rest = [out(lines.where(short))], lines.where(~short)
    for _ in range(1 + LEVELS):
        alike = F.concat(F.slice("t", 1, depth), F.zip_with(F.slice(F.col("t"), F.lit(depth + 1), F.size("t")), "kept", lambda x, y: F.when(x == y, x).otherwise(field)))
        spelt = rest.join(_skeletons(rest, depth, min_docs), "leaf").withColumn("alike", alike)
        same = F.size("t") - (open_(F.col("alike")) - open_(F.col("t")))
        belongs = (same >= similarity * F.size("t")) & (2 * open_(F.col("alike")) <= F.size("t"))
        spelt = saved(spelt.select("leaf", "l1", "l2", "n", "t", "alike", "place", belongs.alias("belongs")))
        found.append(out(spelt.where("belongs").select("l1", "l2", F.col("alike").alias("t"))))
        rest = spelt.where("not belongs").select(F.xxhash64("leaf", "place", F.get("t", F.col("place"))).alias("leaf"), "l1", "l2", "n", "t")
        if rest.isEmpty():
            break
    found.append(out(rest))
    return functools.reduce(DataFrame.union, found)


def drop_recurring_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_docs: int = 5,
    min_tokens: int = 4,
    depth: int = 3,
    similarity: float = 0.7,
    short_lines: bool = False,
) -> DataFrame:
    """The table with recurring lines dropped from ``text``, and the counts ``n_lines`` and
    ``n_dropped`` added, in place of columns of these names.

    Tokens with a digit are variable fields; tokens are cut at ASCII white space. A line falls through the tree by its number of tokens
    and its first ``depth`` tokens to a leaf, where the places whose tokens vary become variable
    fields (see ``leaf_templates``). A template that occurs in ``min_docs`` documents or
    more recurs: its first line (by id, then position) stays, all its others go, copies in
    the same document too. With ``short_lines``, lines of fewer than ``min_tokens`` tokens have a
    leaf by all their tokens, and so recur only as equals after masking; without it they are
    never dropped. Lines without a token always stay.

    A null text stays null (0 lines), an empty one is one empty line. Identical rows count as one
    document; rows that share an id but not the text are documents of their own, null ids sort
    first. Very long texts and lines are read whole. An empty table gives an empty result; other
    columns stay as they are.
    """
    docs = keyed_rows(df, id_column, text)
    least = 1 if short_lines else max(1, min_tokens)

    def leaf(tokens):
        return leaf_of(tokens, depth if len(tokens) >= min_tokens else len(tokens))

    def scan(frames):
        for f in slices(frames, "t"):
            rows = []
            for doc, th, t in zip(f["id"], f["th"], f["t"]):
                held = set()
                for k, line in enumerate(t.split(b"\n")):
                    tokens = masked(line)
                    if len(tokens) >= least:
                        key = _pair(b" ".join(tokens))
                        rows.append((doc, th, k, leaf(tokens), *key, key not in held))
                        held.add(key)
            yield pd.DataFrame(rows, columns=["id", "th", "line", "leaf", "l1", "l2", "first"])

    seen = saved(docs.mapInPandas(scan, "id long, th long, line int, leaf long, l1 long, l2 long, first boolean"))
    # a leaf can only hold a recurring template if enough documents have lines in it
    leaves = saved(seen.where("first").groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs))

    def lines(frames):
        for f in slices(frames, "t"):
            held: Counter = Counter()
            for t in f["t"]:
                lines_of = {tuple(tokens) for line in t.split(b"\n") if len(tokens := masked(line)) >= least}
                held.update((leaf(list(tokens)), b" ".join(tokens)) for tokens in lines_of)
            rows = [(k, t.decode(), *_pair(t), n) for (k, t), n in held.items()]
            yield pd.DataFrame(rows, columns=["leaf", "tokens", "l1", "l2", "n"])

    distinct = docs.mapInPandas(lines, "leaf long, tokens string, l1 long, l2 long, n long").join(leaves.select("leaf"), "leaf")
    distinct = saved(distinct.groupBy("leaf", "l1", "l2").agg(F.sum("n").alias("n"), F.min("tokens").alias("tokens")))
    templates = leaf_templates(distinct, min_docs, min_tokens, depth, similarity)
    met = saved(seen.join(templates, ["l1", "l2"]).select("t1", "t2", "id", "th", "line"))
    release(leaves, distinct)
    recurring = (
        met.groupBy("t1", "t2", "id", "th").agg(F.min("line").alias("line"))
        .groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("id", "th", "line")).alias("first"))
        .where(F.col("docs") >= min_docs).drop("docs")
    )
    # read again, so that the join is free to split a template that a large share of lines has
    recurring = saved(recurring)
    dropped = met.join(recurring, ["t1", "t2"]).where(F.struct("id", "th", "line") != F.col("first"))
    lost, key, hashed = fresh(df, "lost"), fresh(df, "key"), fresh(df, "hash")
    dropped = saved(dropped.groupBy(F.col("id").alias(key), F.col("th").alias(hashed)).agg(F.collect_set("line").alias(lost)))
    release(seen, met, recurring)

    @F.pandas_udf("string")
    def without(t: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for x, g in zip(t, gone):
            if x is None or g is None:
                out.append(x)
                continue
            g = set(g)
            out.append("\n".join(line for k, line in enumerate(x.split("\n")) if k not in g))
        return pd.Series(out, dtype=object)

    rows = df.withColumns({key: F.coalesce(F.col(id_column).cast("long"), F.lit(NONE)), hashed: F.xxhash64(F.coalesce(F.col(text).cast("binary"), F.lit(bytearray())))})
    # texts that lose nothing are not shuffled
    unsure, whole = sifted(rows, sieve(dropped, key, hashed), key, hashed)
    out = unsure.join(dropped, [key, hashed], "left").unionByName(whole.withColumn(lost, F.lit(None).cast("array<int>")))
    count = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)
    return out.select(
        *[F.col(named(c)) for c in df.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")],
        F.when(F.col(lost).isNull(), F.col(text)).otherwise(without.asNondeterministic()(text, lost)).alias(text),
        count.cast("long").alias("n_lines"),
        F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost)).cast("long").alias("n_dropped"),
    )
