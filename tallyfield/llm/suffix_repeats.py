"""Byte strings that repeat anywhere in a corpus, by a distributed difference-cover suffix order.

A suffix order of every byte of the corpus would move many times the corpus through the
shuffle. Texts are therefore parsed into phrases first, cut where the text itself says so (at
grams with a smaller hash than all near them), so equal passages have equal phrases inside,
whatever surrounds them. The difference-cover algorithm orders the suffixes of the
phrase strings: triples at the sampled positions (1 and 2 modulo 3) are sorted and named,
the names are ordered in turn, the remaining suffixes follow from a symbol and the rank of
the suffix behind it, and neighbours in the order share the longest prefixes. What is left to
decide are strings that end inside a phrase, and those with hardly any cut in them; these are
compared by hashes of all their bytes.

What rests on hashes, plainly: the names of phrases (64 bits), and the strings that end inside
phrases, which meet by the phrases inside them (64 bits) and their remaining bytes (64 bits). The
order is recursed on once: names of triples of names cover nine phrases, more than a string holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, mix64, named, prefix_hashes, release, saved, scattered_grams, sieve, sifted, slices, span_hashes

GRAM = 32  # bytes of the grams whose hashes decide where phrases are cut
REACH = 9  # phrases that a sorted prefix covers: a triple of names of triples
NONE = -(1 << 63)  # stands for "no phrase here"


def cuts(prefix: np.ndarray, radius: int) -> np.ndarray:
    """Positions of the grams whose hash is the smallest of all up to ``radius`` away, the first of
    equal ones. Whether a position is one depends on these grams alone."""
    n = len(prefix) - GRAM
    if n < 1:
        return np.empty(0, dtype=np.int64)
    low, width = np.uint64(0xFFFFFF), 2 * radius + 1
    key = scattered_grams(prefix, GRAM)
    key &= ~low
    key |= np.arange(n, dtype=np.uint64) & low
    rows = -(-(n + 2 * radius) // width)
    full = np.full(rows * width, ~np.uint64(0))
    full[radius : radius + n] = key
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(full, axis=1).ravel()
    return np.flatnonzero(np.minimum(ahead[:n], behind[2 * radius : 2 * radius + n]) == key)


def _inner(at: np.ndarray, size: int, length: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last cut that each string of ``length`` bytes of a text determines by itself."""
    held = np.zeros(size + 1, dtype=np.int32)
    held[at + 1] = 1
    held = np.cumsum(held, dtype=np.int32)  # held[x]: cuts before position x
    n, end = size - length + 1, length - GRAM - radius + 1
    return held[radius : radius + n], held[end : end + n] - 1


def _hashed(raw: np.ndarray, prefix: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the strings of ``length`` bytes at the positions."""
    if not len(at):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
    second = span_hashes(prefix_hashes(raw, 1), at, at + length) >> np.uint64(33)
    return span_hashes(prefix, at, at + length).view(np.int64), second.astype(np.int32)


def _parse(docs: DataFrame, length: int, radius: int) -> DataFrame:
    """Per row: key, size, two hashes of the whole text, the hash of each phrase (from a cut to
    the end of the next cut's gram), and the strings with fewer than two cuts of their own: the
    starts [own_low, own_high) of those that the text repeats, and each distinct one."""

    def parse(frames):
        for f in slices(frames, "t", 1 << 20):
            out = []
            for t in f["t"]:
                raw = np.frombuffer(t or b"", dtype=np.uint8)
                whole = hashlib.blake2b(t or b"", digest_size=16).digest()
                row = [len(raw), int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)]
                if len(raw) < length:
                    out.append((*row, [], [], [], [], [], []))
                    continue
                prefix = prefix_hashes(raw)
                at = cuts(prefix, radius)
                p, q = _inner(at, len(raw), length, radius)
                bare = np.flatnonzero(q <= p)
                sym = span_hashes(prefix, at[:-1], at[1:] + GRAM).view(np.int64) if len(at) else []
                h1, h2 = _hashed(raw, prefix, bare, length)
                # of strings that the text itself repeats, one goes on to meet the other texts'
                _, first, place, times = np.unique(h1, return_index=True, return_inverse=True, return_counts=True)
                low, high = _runs_of(bare[times[place] > 1], 1)
                out.append((*row, sym, low.astype(np.int32), high.astype(np.int32), bare[first].astype(np.int32), h1[first], h2[first]))
            yield pd.concat([f[["id", "th"]], pd.DataFrame(out, columns=["n", "w1", "w2", "sym", "own_low", "own_high", "at", "h1", "h2"])], axis=1)

    return docs.mapInPandas(
        parse,
        "id long, th long, n long, w1 long, w2 long, sym array<long>, own_low array<int>, own_high array<int>, at array<int>, h1 array<long>, h2 array<int>",
    )


def _named(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of the columns with names that sort as they do."""
    return saved(df.select(*columns).distinct().orderBy(*columns).withColumn("name", F.monotonically_increasing_id()))


def _recurring(flat: DataFrame) -> DataFrame:
    """The rows of (doc, idx, s0) whose s0 another row has too, in one shuffle."""

    def keep(batches):
        rest, met = None, False  # the last row, and whether the one before it has its s0
        for batch in batches:
            if not batch.num_rows:
                continue
            s = batch.column("s0").to_numpy()
            like = s[1:] == s[:-1]
            first = rest is not None and rest.column("s0")[0].as_py() == s[0]
            if rest is not None and (met or first):
                yield rest
            hit = np.append(first, like)
            hit[:-1] |= like
            if hit[:-1].any():
                yield batch.slice(0, len(s) - 1).filter(pa.array(hit[:-1]))
            rest, met = batch.slice(len(s) - 1), bool(hit[-1])
        if rest is not None and met:
            yield rest

    return flat.repartition("s0").sortWithinPartitions("s0").mapInArrow(keep, "doc long, idx int, s0 long")


def longest_runs(symbols: DataFrame, keys: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """(keys, idx, m) for phrase strings given as (keys, idx int, s0 long), idx numbering the
    phrases of a string: how many phrases from idx on, at most REACH, occur somewhere else in
    the same order. A gap in idx ends a suffix. Also the tables to release when this is read."""
    order = Window.partitionBy(*keys).orderBy("idx")
    lead = [F.when(F.lead("idx", k).over(order) == F.col("idx") + k, F.lead("s0", k).over(order)) for k in range(1, REACH)]
    rows = symbols.select(*keys, "idx", "s0", *[F.coalesce(c, F.lit(NONE)).alias(f"s{k + 1}") for k, c in enumerate(lead)])
    rows = rows.withColumn("mod", F.col("idx") % 3)

    # sort sampled triples and name them
    triple = ["s0", "s1", "s2"]
    names = _named(rows.where("mod <> 0"), triple)
    sample = rows.where("mod <> 0").select(*keys, "idx", "mod", *triple).join(names, triple).select(*keys, "idx", "mod", "name")
    # recurse on the names: the string of a class (1 or 2 modulo 3) goes on three phrases later
    inner = Window.partitionBy(*keys, "mod").orderBy("idx")
    later = [F.coalesce(F.when(F.lead("idx", k).over(inner) == F.col("idx") + 3 * k, F.lead("name", k).over(inner)), F.lit(-1)).alias(f"n{k}") for k in (1, 2)]
    sample = saved(sample.select(*keys, "idx", F.col("name").alias("n0"), *later))
    ranks_held = _named(sample, ["n0", "n1", "n2"])
    ranks = ranks_held.withColumnRenamed("name", "r")
    ranked = sample.join(ranks, ["n0", "n1", "n2"]).select(*keys, "idx", "r")

    # merge the remaining suffixes: (symbol, rank behind it) against the class 1, (two symbols,
    # rank behind them) against the class 2
    full = rows.join(ranked, [*keys, "idx"], "left").withColumn("r", F.coalesce("r", F.lit(-1)))
    behind = [F.coalesce(F.when(F.lead("idx", k).over(order) == F.col("idx") + k, F.lead("r", k).over(order)), F.lit(-1)).alias(f"r{k}") for k in (1, 2)]
    prefix = [f"s{k}" for k in range(REACH)]
    full = saved(full.select(*keys, "idx", "mod", "r", *prefix, *behind))
    release(names, sample, ranks_held)
    lists = [(full.where("mod <> 0"), ["r"]), (full.where("mod <> 2"), ["s0", "r1"]), (full.where("mod <> 1"), ["s0", "s1", "r2"])]
    found, held = None, []
    for part, by in lists:
        runs, table = _neighbours(part.select(*keys, "idx", *prefix, *[c for c in by if c not in prefix]), keys, by)
        found = runs if found is None else found.union(runs)
        held.append(table)
    release(full)
    return found.groupBy(*keys, "idx").agg(F.max("m").cast("int").alias("m")), held


def _neighbours(rows: DataFrame, keys: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, idx, m) for each row: the longest common prefix with the row before or after it in
    the order ``by``, and the table behind it. Of every task only its first and last row meet on the driver."""
    prefix = [f"s{k}" for k in range(REACH)]
    columns = [*keys, "idx", *prefix]

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.cumprod((a == b) & (a != NONE), axis=1).sum(axis=1)

    def scan(frames):
        part, last, first = TaskContext.get().partitionId(), None, None
        for f in frames:
            if not len(f):
                continue
            f = f[columns]
            if first is None:
                first = f.iloc[:1]
            f = f if last is None else pd.concat([last, f], ignore_index=True)
            s = f[prefix].to_numpy()
            m = np.zeros(len(f), dtype=np.int64)
            if len(f) > 1:
                common = shared(s[:-1], s[1:])
                m[1:] = common
                m[:-1] = np.maximum(m[:-1], common)
            out = f[[*keys, "idx"]].assign(m=m, part=-1, s=None)
            yield out[out["m"] > 0]
            last = f.iloc[-1:]
        if first is not None:
            for side, f in ((0, first), (1, last)):
                yield f[[*keys, "idx"]].assign(m=0, part=2 * part + side, s=[f[prefix].to_numpy()[0]])

    kinds = ", ".join(f"{k} long" for k in keys)
    out = saved(rows.orderBy(*by).mapInPandas(scan, f"{kinds}, idx int, m long, part long, s array<long>"))
    ends = [r.asDict() for r in out.where("part >= 0").orderBy("part").collect()]
    more = []
    for a, b in zip(ends[1::2], ends[2::2]):
        m = int(shared(np.array([a["s"]]), np.array([b["s"]]))[0])
        more += [tuple(r[k] for k in [*keys, "idx"]) + (m,) for r in (a, b) if m]
    inside = out.where("part < 0").select(*keys, "idx", "m")
    return (inside.union(rows.sparkSession.createDataFrame(more, f"{kinds}, idx int, m long")) if more else inside), out


def _windows(raw: np.ndarray, runs: np.ndarray, length: int, radius: int) -> dict:
    """What a text has of strings of ``length`` bytes, given the run of each of its phrases.

    Neighbouring starts whose strings determine the same cuts form a group [low, high) with the
    hash of the phrases between these (``inner``) and of those that cover the strings
    (``outer``). A group is kept if the inner phrases repeat together, and is sure if the
    outer ones do.
    """
    prefix = prefix_hashes(raw)
    at = cuts(prefix, radius)
    m = np.zeros(len(at) + 1, dtype=np.int64)
    m[: len(runs)] = runs
    p, q = _inner(at, len(raw), length, radius)
    low = np.concatenate([[0], np.flatnonzero((np.diff(p) != 0) | (np.diff(q) != 0)) + 1])
    high = np.append(low[1:], len(p))
    p, q = p[low], q[low]
    need = q - p
    likely = (need >= 1) & (m[np.minimum(p, len(at))] >= np.minimum(need, REACH))
    p, q, low, high = p[likely], q[likely], low[likely], high[likely]
    left = np.searchsorted(at, low, side="right") - 1
    right = np.searchsorted(at, high - 1 + length - GRAM)
    sure = (left >= 0) & (right < len(at)) & (right - left <= REACH)
    left, right = np.maximum(left, 0), np.minimum(right, max(0, len(at) - 1))
    sure &= m[left] >= right - left
    return {
        "again": _again(at, m),
        "low": low.astype(np.int32),
        "high": high.astype(np.int32),
        "sure": sure,
        "inner": span_hashes(prefix, at[p], at[q] + GRAM).view(np.int64),
        "outer": span_hashes(prefix, at[left], at[right] + GRAM).view(np.int64),
        "first": at[p].astype(np.int32),
        "last": (at[q] + GRAM).astype(np.int32),
    }


#: Bytes that a run of phrases has at least to be reported as a passage.
PASSAGE = 120


def _again(at: np.ndarray, m: np.ndarray) -> int:
    """How many bytes lie in runs of phrases, of ``PASSAGE`` bytes or more each, that occur elsewhere too."""
    k = np.flatnonzero(m[: len(at)])
    start, end = at[k], at[np.minimum(k + m[k], len(at) - 1)] + GRAM
    long = end - start >= PASSAGE
    start, end = start[long], np.maximum.accumulate(end[long]) if long.any() else end[long]
    return int((end - np.maximum(start, np.append(0, end[:-1]))).clip(0).sum()) if len(start) else 0


def _runs_of(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered spans [start, end) of strings of ``length`` bytes at the sorted starts."""
    if not len(starts):
        return starts, starts
    gap = np.flatnonzero(np.diff(starts) > length)
    return starts[np.concatenate([[0], gap + 1])], starts[np.concatenate([gap, [len(starts) - 1]])] + length


def keyed_rows(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, th, t): the id (null as the least long), a hash of the text, and the text's bytes.
    Together id and th stand for a row, so rows that share an id keep apart."""
    t = F.coalesce(F.col(text).cast("binary"), F.lit(bytearray()))
    return df.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NONE)).alias("id"), F.xxhash64(t).alias("th"), t.alias("t"))


#: Groups around the same inner phrases up to which one task compares their strings.
MEMBERS = 20_000


def _members(frames, length: int):
    """A row for each group that is not sure, and for each that stands for sure ones: its inner phrases, what its
    strings hold before and behind these, where its first string starts, and how far before the inner
    phrases that is."""
    for f in slices(frames, "t", 1 << 20):
        rows = []
        for doc, t, low, high, sure, inner, first, last, stand in zip(f["doc"], f["t"], f["low"], f["high"], f["sure"], f["inner"], f["first"], f["last"], f["stand"]):
            chosen = {r["low"] for r in stand} if stand is not None else ()
            for k in np.flatnonzero(~sure | np.isin(low, list(chosen))):
                rows.append((doc, inner[k], low[k], high[k] - low[k], first[k] - low[k], t[low[k] : first[k]] + t[last[k] : high[k] - 1 + length]))
        if rows:
            yield pd.DataFrame(rows, columns=["doc", "inner", "low", "n", "before", "rest"])


def _string_keys(f: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, key) of every string of the rows: equal strings, and only these, have one key."""
    n, size = f["n"].to_numpy(dtype=np.int64), np.array([len(x) for x in f["rest"]], dtype=np.int64)
    row = np.repeat(np.arange(len(f)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(size) - size)[row] + step
    h = span_hashes(prefix_hashes(np.frombuffer(b"".join(f["rest"]), dtype=np.uint8)), at, at + (size - n + 1)[row])
    place = (f["before"].to_numpy(dtype=np.int64)[row] - step).astype(np.uint64)
    key = mix64(h + mix64(f["inner"].to_numpy(dtype=np.int64).view(np.uint64)[row] + place * np.uint64(0x9FB21C651E98DF25)))
    return row, (f["low"].to_numpy(dtype=np.int64)[row] + step).astype(np.int32), key.view(np.int64)


def _meet(frames):
    """(doc, hits): starts of the strings that occur twice or more among the rows of one inner."""

    def settle(f):
        f = f.reset_index(drop=True)
        row, start, key = _string_keys(f)
        _, of, held = np.unique(key, return_inverse=True, return_counts=True)
        hit = held[of] > 1
        row, start = row[hit], start[hit]
        some, low = np.unique(row, return_index=True)
        if len(some):
            yield pd.DataFrame({"doc": f["doc"].to_numpy()[some], "hits": np.split(start, low[1:])})

    rest = None
    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if not len(f):
            continue
        inner = f["inner"].to_numpy()
        whole = len(f) - int(np.argmax(inner[::-1] != inner[-1])) if (inner != inner[-1]).any() else 0
        if whole:
            yield from settle(f.iloc[:whole])
        rest = f.iloc[whole:]
    if rest is not None and len(rest):
        yield from settle(rest)


def _twice(strings: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(doc, hits) of the strings given as (doc, at, keys) that occur twice or more, and the table behind it. Counted in
    parts first and joined, so no string that very many texts have lies in one task. The strings are read twice."""
    again = strings.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(*keys)
    again = saved(again)
    return strings.join(again, keys).groupBy("doc").agg(F.collect_list("at").alias("hits")), again


def _spans(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans of bytes covered by a string of ``length`` bytes that also starts anywhere else, of texts given
    as (id, th, t).

    Returns ``(spans, classes, passages)``. Classes: per (id, th) that has an exact copy its size ``n``;
    such texts are covered whole. Spans: per affected (id, th) without a copy the arrays ``starts``
    and ``ends`` of its maximal spans. Passages: per (id, th) without a copy the bytes ``again`` of
    runs of phrases that occur elsewhere too, where there are any.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    radius = (length - GRAM) // 11
    parsed = saved(_parse(docs, length, radius).where(F.col("n") >= length).withColumn("doc", F.monotonically_increasing_id()))
    held = parsed.groupBy("n", "w1", "w2").agg(F.count(F.lit(1)).alias("held"), F.min("doc").alias("least")).where("held > 1")
    copies = saved(parsed.select("doc", "id", "th", "n", "w1", "w2").join(held, ["n", "w1", "w2"]).select("doc", "id", "th", "n", "held", "least"))
    # of every class of equal texts one goes on
    unsure, sure = sifted(parsed.drop("n", "w1", "w2"), sieve(copies, "doc"), "doc")
    unsure = unsure.join(copies.select("doc", "held", "least"), "doc", "left").where(F.coalesce(F.col("doc") == F.col("least"), F.lit(True)))
    reps = unsure.withColumn("held", F.coalesce("held", F.lit(1).cast("long"))).drop("least")
    phrased = reps.unionByName(sure.withColumn("held", F.lit(1).cast("long")))
    classes = saved(copies.select("id", "th", "n").distinct())
    reps = saved(phrased.drop("sym"))
    keyed = reps.select("doc", "id", "th", "held")

    symbols = saved(_recurring(phrased.select("doc", F.posexplode("sym").alias("idx", "s0"))))
    release(parsed, copies)
    runs, tables = longest_runs(symbols, ["doc"])
    # a symbol that occurs twice repeats alone at least
    runs = symbols.join(runs, ["doc", "idx"], "left").groupBy("doc").agg(
        F.collect_list(F.struct("idx", F.coalesce("m", F.lit(1)).cast("int").alias("m"))).alias("runs")
    )

    def group(frames):
        for f in slices(frames, "t"):
            out = []
            for t, held in zip(f["t"], f["runs"]):
                at = np.array([r["idx"] for r in held])
                m = np.zeros(at.max() + 1, dtype=np.int64)
                m[at] = np.maximum(1, [r["m"] for r in held])
                out.append(_windows(np.frombuffer(t, dtype=np.uint8), m, length, radius))
            out = pd.DataFrame(out)
            texts = f["t"].where([len(x) > 0 for x in out["low"]], None)
            yield pd.concat([f[["doc", "held"]], texts, out], axis=1)

    # identical rows that share an id give the class's one text twice, which changes no other's result
    lists = "low array<int>, high array<int>, sure array<boolean>, inner array<long>, outer array<long>, first array<int>, last array<int>"
    lists = f"again long, {lists}"
    owners = saved(runs.join(keyed, "doc"))
    texts = sifted(docs, sieve(owners, "id", "th"), "id", "th")[0].join(owners, ["id", "th"]).select("doc", "held", "t", "runs")
    all_groups = saved(texts.mapInPandas(group, f"doc long, held long, t binary, {lists}").where("again > 0 or size(low) > 0"))
    release(symbols, owners, *tables)
    passages = saved(all_groups.where("again > 0 and held = 1").select("doc", "again").join(keyed, "doc").select("id", "th", "again"))
    grouped = all_groups.where(F.size("low") > 0)

    # groups that aren't sure are decided by their strings, against one another and against the sure
    # groups around the same inner phrases, of which one stands for all with equal outer phrases
    groups = grouped.select("doc", F.explode(F.arrays_zip("low", "high", "sure", "inner", "outer")).alias("g")).select("doc", "g.*")
    asked = groups.where("not sure").select("inner").distinct()
    stand = groups.where("sure").join(asked, "inner", "left_semi").groupBy("outer", "inner").agg(F.min(F.struct("doc", "low", "high")).alias("g"))
    picked = stand.groupBy(F.col("g.doc").alias("doc")).agg(F.collect_list(F.struct("g.low", "g.high")).alias("stand"))
    lone = grouped.select("doc", "t", "low", "high", "sure", "inner", "first", "last").join(picked, "doc", "left")
    members = saved(lone.mapInPandas(lambda frames: _members(frames, length), "doc long, inner long, low int, n int, before int, rest binary"))
    sizes = members.groupBy("inner").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    crowded = saved(sizes.where(F.col("k") > MEMBERS).select("inner"))
    few = members.join(crowded, "inner", "left_anti").repartition("inner").sortWithinPartitions("inner")
    met = few.mapInPandas(_meet, "doc long, hits array<int>")

    def opened(frames):
        for f in slices(frames, "rest", 1 << 20):
            row, start, key = _string_keys(f)
            yield pd.DataFrame({"doc": f["doc"].to_numpy()[row], "at": start, "key": key})

    strings = saved(members.join(crowded, "inner").select(*members.columns).mapInPandas(opened, "doc long, at int, key long"))
    many, many_held = _twice(strings, ["key"])
    # lists that a table holds already aren't written once more
    bare = reps.select("doc", F.explode(F.arrays_zip("at", "h1", "h2")).alias("x")).select("doc", "x.at", "x.h1", "x.h2")
    alone, alone_held = _twice(bare, ["h1", "h2"])
    found = met.union(many).union(alone).groupBy("doc").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    surely = grouped.where(F.exists("sure", lambda x: x)).select("doc", "low", "high", "sure")
    own = reps.where("held = 1").select("doc", "id", "th", "own_low", "own_high")
    both = own.join(surely.join(found, "doc", "full"), "doc", "left").where((F.size("own_low") > 0) | F.col("low").isNotNull() | F.col("hits").isNotNull())

    def cover(frames):
        for f in frames:
            out = []
            for low, high, sure, own_low, own_high, hits in zip(f["low"], f["high"], f["sure"], f["own_low"], f["own_high"], f["hits"]):
                parts = [np.arange(a, b) for a, b, s in zip(low, high, sure) if s] if low is not None else []
                parts += [np.arange(a, b) for a, b in zip(own_low, own_high)]
                parts.append(np.asarray(hits if hits is not None else [], dtype=np.int64))
                out.append([x.astype(np.int32) for x in _runs_of(np.unique(np.concatenate(parts)), length)])
            got = pd.DataFrame(out, columns=["starts", "ends"])
            yield pd.concat([f[["id", "th"]].reset_index(drop=True), got], axis=1)

    spans = saved(both.mapInPandas(cover, "id long, th long, starts array<int>, ends array<int>"))
    release(all_groups, members, reps, crowded, strings, many_held, alone_held)
    return spans, classes, passages


def _whole(classes: DataFrame) -> DataFrame:
    return classes.select("id", "th", F.array(F.lit(0)).alias("starts"), F.array(F.col("n").cast("int")).alias("ends"))


def repeated_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """Per affected (id, th) of ``keyed_rows`` the arrays ``starts`` and ``ends`` of its maximal spans of bytes
    covered by a string of ``length`` bytes that also starts anywhere else."""
    spans, classes, _ = _spans(keyed_rows(df, id_column, text), length)
    return spans.union(_whole(classes))


def remove_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """The table with every byte removed from ``text`` that a repeated string of ``length`` bytes
    covers; bytes that no longer form UTF-8 are dropped. Nulls stay null, empty and shorter texts as they
    are; all rows and columns stay. Rows that share id and text are copies of each other."""
    spans = saved(repeated_spans(df, id_column, text, length))
    t = F.coalesce(F.col(text).cast("binary"), F.lit(bytearray()))
    key, hashed = fresh(df, "key"), fresh(df, "hash")
    starts, ends = fresh(df, "starts"), fresh(df, "ends")
    rows = df.withColumns({key: F.coalesce(F.col(id_column).cast("long"), F.lit(NONE)), hashed: F.xxhash64(t)})
    held = spans.select(F.col("id").alias(key), F.col("th").alias(hashed), F.col("starts").alias(starts), F.col("ends").alias(ends))
    unsure, whole = sifted(rows, sieve(held, key, hashed), key, hashed)
    cut = unsure.join(held, [key, hashed], "left")

    @F.pandas_udf("string")
    def clean(t: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        def one(x, a, b):
            if x is None or a is None:
                return x
            raw, kept, at = x.encode(), [], 0
            for i, j in zip(a, b):
                kept.append(raw[at:i])
                at = j
            return b"".join([*kept, raw[at:]]).decode("utf-8", "ignore")

        return pd.Series([one(x, a, b) for x, a, b in zip(t, starts, ends)], dtype=object)

    cleaned = F.when(F.col(starts).isNull(), F.col(text)).otherwise(clean.asNondeterministic()(text, starts, ends))
    columns = [named(c) for c in df.columns]
    return whole.select(*columns).union(cut.withColumn(text, cleaned).select(*columns))


def repeat_report(df: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, has_passage``.

    Texts are UTF-8 bytes, null as empty; matches stay within a document but may lie twice in the
    same one, overlapping too; all strings are judged on the input. Texts shorter than ``length``
    lose nothing. Beside that, ``n_passage_bytes`` counts the bytes in runs of phrases, of ``PASSAGE``
    bytes or more, that occur elsewhere too: what the suffix order finds of passages too short to
    be removed (of strings of 400 bytes; every shared passage of 320 bytes or more holds such a
    run). It counts whole texts of ``length`` or more that have a copy, and no text shorter than that.
    Rows that share id and text are copies of each other. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = keyed_rows(df, id_column, text)
    spans, classes, passages = _spans(rows, length)
    covered = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    short = passages.union(classes)
    docs = rows.select("id", "th", F.length("t").cast("long").alias("n"), F.sha2("t", 256).alias("sha"))
    counted = spans.union(_whole(classes)).select("id", "th", covered.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"))

    @F.pandas_udf("string")
    def digest(t: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for x, a, b in zip(t, starts, ends):
            h, at = hashlib.sha256(), 0
            for i, j in zip(a, b):
                h.update(x[at:i])
                at = j
            h.update(x[at:])
            out.append(h.hexdigest())
        return pd.Series(out, dtype=object)

    # texts without spans are not shuffled
    unsure, _ = sifted(rows, sieve(spans, "id", "th"), "id", "th")
    cut = unsure.join(spans, ["id", "th"]).select("id", "th", digest("t", "starts", "ends").alias("cut_sha"))
    empty = hashlib.sha256(b"").hexdigest()
    out = docs.join(counted, ["id", "th"], "left").join(cut, ["id", "th"], "left").join(short, ["id", "th"], "left")
    zero = F.lit(0).cast("long")
    passage = F.greatest(F.coalesce("again", zero), F.coalesce("n_removed", zero))
    return out.select(
        F.when(F.col("id") != NONE, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.when(F.col("n_removed") == F.col("n"), F.lit(empty)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        passage.alias("n_passage_bytes"),
        (passage > 0).alias("has_passage"),
    )
