"""Exact n-gram Jaccard join in the metric space of word-shingle sets.

The Jaccard distance is a metric, so distances to pivots bound distances between documents.
Texts that share nothing are all at distance 1, where no pivot tells them apart; the join
therefore first cuts the space into coarse regions that no link can leave, and the pivots
work inside these:

1. Of two linked sets, each holds at least ``similarity`` of the other. Taken in one order of all
   shingles (those of rare words first, frequent ones last), the first few of either then include one in common: every such
   shingle is the seed of a region. In a region two sets are neighbours unless their sizes, or
   the distances to fixed pivots (32 or more sets of shingles by hash), already differ too much: the
   triangle inequality bounds the number of differing shingles from below. The components of
   neighbours are the regions that the pivots divide.
2. In a region, pivots create Voronoi cells; a document joins every cell whose pivot is at
   most 2r farther than its nearest (r: the link distance), so two linked documents always
   meet in the home cell of either. Cells are split again in the same way until few documents
   remain, which are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, distinct, local_components, mix64, named, per_key, release, saved, shingle_hashes, shingle_set, sieve, sifted, slices, words_by_text


BUCKETS = 32


#: Words are told apart by as many buckets where their frequency is asked for.
WORDS = 1 << 18


def _bucket(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - WORDS.bit_length() + 1)


def rare_first(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The different ones of a text's shingles: those of rare words come first, as hardly any texts but copies share
    them, however many texts there are."""
    s = shingles[np.argsort(weights << np.uint64(56) | shingles >> np.uint64(8))]
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def shingles_by_text(texts, words: int, counts: np.ndarray):
    """For each text its shingles, as often as they come, and their weights: binary digits of how frequent their words are, 255 at most."""
    for h, at in words_by_text(texts):
        of_word = counts[_bucket(h)].astype(np.uint64)

        def weights(of_word, n):
            return np.minimum(sum((of_word[k : k + n] for k in range(len(of_word) - n + 1)), np.zeros(n, dtype=np.uint64)), 255).astype(np.uint64)

        whole = shingle_hashes(h, words)
        heavy = weights(of_word, len(whole))
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= words:
                yield whole[a : b - words + 1], heavy[a : b - words + 1]
            else:
                s = shingle_hashes(h[a:b], words)
                yield s, weights(of_word[a:b], len(s))


def first_shingles(s: np.ndarray, n: int, frequent: np.ndarray, part: int, share: int) -> np.ndarray:
    """The first of a set's ``n`` shingles in their order, frequent ones coming last, of which linked sets share one."""
    need = n - -(-part * n // share) + 1
    for head in (s[: 2 * need], s) if len(frequent) else ():  # seldom are more than the first ones asked for
        often = frequent[np.minimum(np.searchsorted(frequent, head), len(frequent) - 1)] == head
        if len(head) - often.sum() >= need or len(head) == len(s):
            return np.concatenate([head[~often], head[often]])[:need]
    return s[:need]


def sketch(mixed: np.ndarray) -> bytes:
    """How many shingles of a set, mixed once more, lie in each of the fixed pivot sets, 255 at most. Sets of more than
    256 shingles have more pivots, each of which halves one of a smaller set's: at eight shingles
    in each, unrelated texts of any length differ by more than linked ones may."""
    bits = max(5, ((len(mixed) - 1) // 8).bit_length())
    held = np.bincount((mixed >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(held, 255).astype(np.uint8).tobytes()


class Sketches:
    """Sizes and sketches of sets, by which most pairs that can't link are told apart."""

    def __init__(self, n: np.ndarray, sketches, part: int, share: int):
        self.n, self.part, self.share = n, part, share
        self.width = np.array([len(x) for x in sketches], dtype=np.int64)
        #: for each width, the row of every set in the matrix of those at least as wide, cut down to it
        self.tables = {}
        for width in np.unique(np.append(self.width, BUCKETS)):
            rows = np.flatnonzero(self.width >= width)
            table = np.zeros((len(rows), width), dtype=np.int16)
            for w in np.unique(self.width[rows]):
                at = np.flatnonzero(self.width[rows] == w)
                flat = np.frombuffer(b"".join(sketches[r] for r in rows[at]), dtype=np.uint8)
                table[at] = flat.reshape(len(at), width, w // width).sum(axis=2)
            place = np.full(len(n), -1)
            place[rows] = np.arange(len(rows))
            self.tables[int(width)] = place, table

    def _fits(self, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
        place, table = self.tables[width]
        out, step = np.empty(len(i), dtype=bool), max(1, (1 << 21) // width)
        for at in range(0, len(i), step):
            a, b = i[at : at + step], j[at : at + step]
            apart = np.abs(table[place[a]] - table[place[b]]).sum(axis=1, dtype=np.int64)
            out[at : at + step] = (self.share + self.part) * apart <= (self.share - self.part) * (self.n[a] + self.n[b])
        return out

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sets i and j may link, going by their sizes and sketches."""
        a, b = self.n[i], self.n[j]
        ok = self.share * np.minimum(a, b) >= self.part * np.maximum(a, b)
        at = np.flatnonzero(ok)
        ok[at] = self._fits(i[at], j[at], BUCKETS)
        finer = np.minimum(self.width[i], self.width[j])
        for width in np.unique(finer[ok]):
            if width > BUCKETS:
                at = np.flatnonzero(ok & (finer == width))
                ok[at] = self._fits(i[at], j[at], int(width))
        return ok


def similar(common: np.ndarray, a: np.ndarray, b: np.ndarray, part: int, share: int) -> np.ndarray:
    """share * |intersection| >= part * |union|, in whole numbers."""
    return share * common >= part * (a + b - common)


def overlap(one: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many members of the sorted set each of the sets has that lie in ``flat`` up to ``ends``."""
    hit = np.append(one, one[-1:])[np.searchsorted(one, flat)] == flat
    return np.diff(np.concatenate([[0], np.cumsum(hit)])[ends])


def metric_join(sets: list[np.ndarray], part: int, share: int, leaf: int = 64, pivots: int = 8) -> np.ndarray:
    """For each set the smallest index reachable by links. Splits by pivots, recursively."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    radius = 1 - part / share + 1e-9
    left, right = [], []

    def to_pivot(i: int, rows: np.ndarray) -> np.ndarray:
        """Distances of the rows to set i; its links are noted."""
        flat = np.concatenate([sets[r] for r in rows])
        common = overlap(sets[i], flat, np.concatenate([[0], np.cumsum(size[rows])]))
        near = rows[similar(common, size[rows], size[i], part, share)]
        left.append(np.full(len(near), i))
        right.append(near)
        return 1 - common / (size[rows] + size[i] - common)

    def all_pairs(rows: np.ndarray) -> None:
        """Every pair of the rows, by products of the incidence of shingles that two rows share."""
        flat, row = np.concatenate([sets[r] for r in rows]), np.repeat(np.arange(len(rows)), size[rows])
        _, at, held = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.cumsum(held > 1) - 1
        keep = held[at] > 1
        row, at = row[keep], rank[at[keep]]
        common = np.zeros((len(rows), len(rows)), dtype=np.float32)
        for low in range(0, int(at.max()) + 1 if len(at) else 0, 4096):
            inside = (at >= low) & (at < low + 4096)
            one = np.zeros((len(rows), 4096), dtype=np.float32)
            one[row[inside], at[inside] - low] = 1
            common += one @ one.T
        found = similar(common.astype(np.int64), size[rows][:, None], size[rows][None, :], part, share)
        i, j = np.nonzero(np.triu(found, 1))
        left.append(rows[i])
        right.append(rows[j])

    todo = [np.flatnonzero(size > 0)]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            if len(rows) > 1:
                all_pairs(rows)
            continue
        # pivots far from one another: each is the document farthest from the ones before, until every
        # document links with one or there is one for each eight documents
        nearest, table, chosen = np.full(len(rows), np.inf), [], []
        while len(chosen) < max(pivots, len(rows) // 8):
            at = int(np.argmax(nearest)) if chosen else 0
            if chosen and nearest[at] <= (radius if len(chosen) >= pivots else 0):
                break
            chosen.append(at)
            table.append(to_pivot(rows[at], rows))
            nearest = np.minimum(nearest, table[-1])
        others = np.ones(len(rows), dtype=bool)
        others[chosen] = False  # a pivot's links are all known now
        table = np.stack(table)[:, others]
        rows, nearest = rows[others], nearest[others]
        home = table.argmin(0)
        cells = []
        for p in range(len(table)):
            if (home == p).any():
                cell = (table[p] <= nearest + 2 * radius) & (table[p] <= nearest[home == p].max() + radius)
                if not (table[p][cell] <= radius).all():  # else all of them link with the pivot
                    cells.append(rows[cell])
        if sum(len(c) ** 2 for c in cells) < 0.8 * len(rows) ** 2:
            todo += cells
        else:  # the documents are too close together for pivots to part them
            all_pairs(rows)
    if not left:
        return np.arange(len(sets))
    return local_components(len(sets), np.concatenate(left), np.concatenate(right))


def _keyed(docs: DataFrame, words: int, part: int, share: int, frequent: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Per row the size of its set, a number that stands for the set, its sketch and its first shingles."""

    def build(frames):
        for f in slices(frames, "t"):
            rows = []
            for shingles, weights in shingles_by_text(f["t"], words, counts):
                s = distinct(shingles)
                mixed = mix64(s)
                whole = s.sum(dtype=np.uint64).view(np.int64), mixed.sum(dtype=np.uint64).view(np.int64)
                keys = first_shingles(rare_first(shingles, weights), len(s), frequent, part, share).view(np.int64)
                rows.append((len(s), *map(int, whole), sketch(mixed), keys))
            yield pd.concat([f[["id"]].astype("Int64"), f[["th"]], pd.DataFrame(rows, columns=["n", "h1", "h2", "sketch", "keys"])], axis=1)

    out = docs.mapInPandas(build, "id long, th long, n long, h1 long, h2 long, sketch binary, keys array<long>")
    return out.select("id", "th", "n", F.xxhash64("n", "h1", "h2").alias("node"), "sketch", "keys")


def _shingled(texts: DataFrame, words: int) -> DataFrame:
    def build(frames):
        for f in slices(frames, "t"):
            yield pd.DataFrame({"id": f["node"], "s": [shingle_set(t, words).tobytes() for t in f["t"]]})

    return texts.mapInPandas(build, "id long, s binary")


def frequencies(docs: DataFrame, words: int, part: int, share: int, sample_docs: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """From a bounded sample of documents, the binary digits of its words' counts by their buckets, and sorted shingles of rare
    words that several documents have all the same (of passages that many texts hold), the ``most`` most frequent.
    They only decide an order: any of them give the same links."""
    total = docs.count()
    kept = min(1_000_000, -(-1_000_000 * sample_docs // max(1, total)))
    sample = saved(docs.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < kept).select("t"))

    def buckets(frames):
        for f in slices(frames, "t"):
            found, k = np.unique(_bucket(np.concatenate([h for h, _ in words_by_text(f["t"])])), return_counts=True)
            yield pd.DataFrame({"s": found.view(np.int64), "k": k})

    seen = sample.mapInPandas(buckets, "s long, k long").groupBy("s").agg(F.sum("k").alias("n")).toPandas()
    counts = np.zeros(WORDS, dtype=np.uint8)
    counts[seen["s"].to_numpy(dtype=np.int64)] = np.ceil(np.log2(1 + seen["n"].to_numpy(dtype=np.float64)))

    def firsts(frames):
        for f in slices(frames, "t"):
            sets = [rare_first(*x) for x in shingles_by_text(f["t"], words, counts)]
            # twice as many as are taken: those that come next once others are known to be frequent
            yield pd.DataFrame({"s": np.concatenate([first_shingles(s, 2 * len(s), (), part, share) for s in sets]).view(np.int64)})

    held = sample.mapInPandas(firsts, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = held.orderBy(F.desc("n"), "s").limit(most).select("s").toPandas()["s"].to_numpy(dtype=np.int64)
    release(sample)
    return np.sort(often.view(np.uint64)), counts


def _gathered(spread: DataFrame, most: int) -> DataFrame:
    """(held, who, low, ids) for each key that several sets of (key, id) have: how many, a number that stands for them,
    the least, and all. Of a key of more than ``most`` sets they come in pieces, held being 0."""

    def gather(batches):
        keys, ids, large = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), False

        def groups(keys, ids, large):
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(starts, len(keys)))
            held = np.where(sizes > most, 0, sizes)
            held[0] = 0 if large else held[0]
            who = np.add.reduceat(mix64(ids.view(np.uint64)), starts).view(np.int64)
            some = sizes > 1
            offsets = np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[np.repeat(some, sizes)]))
            columns = [pa.array(x[some]) for x in (held.astype(np.int64), who, ids[starts])]
            return pa.RecordBatch.from_arrays([*columns, lists], names=["held", "who", "low", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in ((keys, "key"), (ids, "id")))
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield groups(keys[:cut], ids[:cut], large)
                keys, ids, large = keys[cut:], ids[cut:], False
            if len(keys) > most:  # the least stands for those that are told already
                yield groups(keys, ids, True)
                keys, ids, large = keys[:1], ids[:1], True
        if len(keys):
            yield groups(keys, ids, large)

    sorted_ = spread.repartition("key").sortWithinPartitions("key", "id")
    return sorted_.mapInArrow(gather, "held long, who long, low long, ids array<long>")


def _meetings(rows: DataFrame, part: int, share: int) -> DataFrame:
    """Pairs (a, b) that join the neighbours among the sets of each key. Keys of more rows than a task
    may hold don't come here."""

    def pairs(f):
        key, ids, n = f["key"].to_numpy(), f["id"].to_numpy(), f["n"].to_numpy()
        known = Sketches(n, f["sketch"].to_list(), part, share)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(f)))
        # small groups: every two rows, a step between them at a time
        small = np.repeat(sizes <= 12, sizes)
        for step in range(1, 12):
            i = np.flatnonzero(small[:-step] & (key[step:] == key[:-step]))
            if not len(i):
                break
            i = i[known.near(i, i + step)]
            yield ids[i], ids[i + step]
        for at, size in zip(starts[sizes > 12], sizes[sizes > 12]):
            moved, low = grown(known, n, at, size)
            yield ids[moved], ids[low]

    def grown(known, n, at, size):
        """The neighbours of a large group, each with one that it is joined to. Only rows that aren't joined yet are compared."""
        left, moved, low = np.arange(at, at + size), [], []
        while len(left):
            first, left = left[0], left[1:]
            todo = [first]
            while todo and len(left):
                k = todo.pop()
                a, b = np.searchsorted(n[left], (-(-part * n[k] // share), share * n[k] // part + 1))
                hit = known.near(np.full(b - a, k), left[a:b])
                if hit.any():
                    found = left[a:b][hit]
                    left = np.concatenate([left[:a], left[a:b][~hit], left[b:]])
                    todo.extend(found)
                    moved.append(found)
                    low.append(np.full(len(found), first))
        return (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (moved, low))

    def run(frames):
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if not len(f):
                continue
            key = f["key"].to_numpy()
            cut = len(key) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
            if cut:
                yield edges(f.iloc[:cut])
            rest = f.iloc[cut:]
        if rest is not None and len(rest):
            yield edges(rest)

    def edges(f):
        found = list(pairs(f))
        return pd.DataFrame({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([y for _, y in found])}) if found else pd.DataFrame({"a": [], "b": []})

    return rows.repartition("key").sortWithinPartitions("key", "n", "id").mapInPandas(run, "a long, b long")


def _dealt(rows: DataFrame, part: int, share: int, most: int) -> DataFrame:
    """The rows (key, id, n, sketch) of keys that more sets have than a task may hold, under new keys, of which every two sets that
    may link share one: a key is cut into bands of sizes, of which linked sets have the same or the next one, and
    a band that is still large into blocks, every two of which meet."""
    band = F.floor(F.log("n") / (float(np.log(share / part)) * 1.0001 + 1e-9)).cast("long")
    banded = rows.withColumn("band", F.explode(F.array(band, band + 1)))
    blocks = banded.groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = banded.join(blocks, ["key", "band"]).select("key", "band", "id", "n", "sketch", own.alias("own"), each)
    return met.select(F.xxhash64("key", "band", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "id", "n", "sketch")


def jaccard_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 3,
    part: int = 90,
    share: int = 100,
    cell_rows: int = 2000,
    cell_shingles: int = 1_500_000,
    open_rows: int = 256,
    sample_docs: int = 10_000,
    frequent: int = 100_000,
) -> DataFrame:
    """Groups documents linked by ``share * |intersection| >= part * |union|`` of their sets
    of distinct word shingles: per row of the input ``doc_id, n_shingles, component_id``.

    Words are maximal runs without the bytes 0x20 and 0x09-0x0D, A-Z lower-cased. A text of
    fewer words than a shingle has its whole sequence as one shingle; null, empty and blank
    texts have none and link with nothing. Every text is read whole. Rows with a null id stay,
    with null component. Rows that share an id are one node: whatever one of their texts links with, all
    of them reach. Sets are told apart by 64-bit hashes. Other columns are ignored; an empty table gives an
    empty result. A task compares the sets of a region or cell, of at most ``cell_rows`` sets and
    ``cell_shingles`` shingles, or two blocks of it.
    """
    text_bytes = F.col(named(text)).cast("binary")
    docs = df.select(F.col(named(id_column)).cast("long").alias("id"), text_bytes.alias("t"), F.xxhash64(text_bytes).alias("th"))
    often, counts = frequencies(docs, words, part, share, sample_docs, frequent)
    wide = saved(_keyed(docs, words, part, share, often, counts))
    keyed = saved(wide.select("id", "th", "n", "node"))

    # every different set is one node, whatever rows have it; the first of these brings its text
    held = wide.where("n > 0 and id is not null").groupBy("node")
    held = saved(held.agg(F.min(F.struct("id", "th")).alias("row"), *[F.first(c).alias(c) for c in ("n", "sketch", "keys")]))
    release(wide)
    placed, nodes = keyed.where("n > 0 and id is not null"), saved(held.drop("keys"))

    gathered = saved(_gathered(held.select(F.col("node").alias("id"), F.explode("keys").alias("key")), cell_rows))
    release(held)
    # keys with the same sets say the same: one of them is enough
    telling = gathered.where("held > 0").dropDuplicates(["held", "who", "low"]).select(F.monotonically_increasing_id().alias("key"), "ids")
    telling = saved(telling)
    sized = nodes.select(F.col("node").alias("id"), "n", "sketch")
    met = telling.select("key", F.explode("ids").alias("id")).join(sized, "id")
    many = gathered.where("held = 0").select(F.col("low").alias("key"), F.explode("ids").alias("id")).distinct().join(sized, "id")
    region = saved(components(_meetings(met.unionByName(_dealt(saved(many), part, share, cell_rows)), part, share)))
    release(gathered, telling)

    inside = region.join(nodes.select("node", "n", "row"), "node")
    load = F.greatest(F.count(F.lit(1)) / cell_rows, F.sum("n") / cell_shingles)
    several = inside.groupBy("component").agg(F.count(F.lit(1)).alias("held"), load.alias("load")).where("held > 1")
    inside = saved(inside.join(several, "component").select(F.col("node").alias("id"), F.col("component").alias("region"), "held", "load", "row"))
    asked = inside.select("row.id", "row.th", F.col("id").alias("node"))
    texts = sifted(docs, sieve(asked, "id", "th"), "id", "th")[0].join(asked, ["id", "th"]).dropDuplicates(["node"])
    sets = saved(_shingled(texts, words).join(inside.drop("row"), "id"))
    release(region, inside)

    def join(frames):
        for f in per_key(frames, ["region"]):
            found = metric_join([np.frombuffer(s, dtype=np.uint64) for s in f["s"]], part, share)
            ids = f["id"].to_numpy()
            moved = np.flatnonzero(found != np.arange(len(ids)))
            yield pd.DataFrame({"a": ids[moved], "b": ids[found[moved]]})

    small = sets.where("load <= 1")
    links = small.repartition("region").sortWithinPartitions("region", "id").mapInPandas(join, "a long, b long")
    links = links.union(_large_regions(sets.where("load > 1"), part, share, cell_rows, cell_shingles, open_rows))
    groups = saved(components(links))
    owned = placed.select("id", "node").distinct().join(groups, "node", "left").select("id", F.coalesce("component", "node").alias("group")).distinct()
    owned = saved(owned)
    release(nodes, sets, groups)
    # an id with texts of several groups joins these
    shared = owned.groupBy("id").agg(F.min("group").alias("b"), F.max("group").alias("c")).where("b < c").select("id", "b")
    joined = components(owned.join(shared, "id").select(F.col("group").alias("a"), "b")).withColumnRenamed("node", "group")
    merged = owned.join(joined, "group", "left").select("id", F.coalesce("component", "group").alias("group"))
    least = merged.groupBy("group").agg(F.min("id").alias("component"))
    found = merged.distinct().join(least, "group").select("id", "component")
    return keyed.join(found, "id", "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def _measured(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """(region, id, pivot, c, u): the shingles in common and in all, for every member of a region and every
    pivot of it but itself. A region is measured in parts, each of which has all its pivots."""
    parts = F.ceil("load").cast("int")
    chosen = pivots.select("region", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("kind"), "id", "s")
    dealt = members.select("region", F.pmod(F.xxhash64("id", F.lit(1)), parts).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "s")

    def measure(frames):
        for f in per_key(frames, ["region", "part"]):
            rows, at = f[f["kind"] == 1], f[f["kind"] == 0]
            if not len(rows):
                continue
            held = [np.frombuffer(s, dtype=np.uint64) for s in rows["s"]]
            size, flat = np.array([len(m) for m in held]), np.concatenate(held)
            ends = np.concatenate([[0], np.cumsum(size)])
            for pivot, s in zip(at["id"], at["s"]):
                one = np.frombuffer(s, dtype=np.uint64)
                c = overlap(one, flat, ends)
                out = pd.DataFrame({"region": rows["region"], "id": rows["id"], "pivot": pivot, "c": c, "u": size + len(one) - c})
                yield out[out["id"] != pivot]

    met = chosen.union(dealt).repartition("region", "part").sortWithinPartitions("region", "part", "kind", "id")
    return saved(met.mapInPandas(measure, "region long, id long, pivot long, c long, u long"))


def _large_regions(sets: DataFrame, part: int, share: int, cell_rows: int, cell_shingles: int, open_rows: int, pivots: int = 16) -> DataFrame:
    """Links of regions too large for one task.

    All links of a round of pivots are known at once. Documents that these put into one
    component need no comparing among themselves, so only the documents outside a region's largest
    component, the open ones, are left to compare with all others: as pivots of their own where
    they are few, else in the Voronoi cells of the first pivots. A cell that is still large is
    compared in blocks, every two blocks in a task.
    """
    radius = 1 - part / share + 1e-9
    is_pivot = F.pmod(F.xxhash64("id"), F.ceil(F.col("held") / pivots)) == 0
    measured = _measured(sets, sets.where(is_pivot))
    linked = F.col("c") * share >= F.col("u") * part
    to_pivot = measured.where(linked).select(F.col("id").alias("a"), F.col("pivot").alias("b"))

    comp = saved(components(to_pivot))
    light = sets.select("region", "id", is_pivot.alias("pivot"), (F.length("s") / 8).alias("n"))
    light = light.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    main = light.groupBy("region", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("region").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
    open_ = light.join(main, "region").where((F.col("component") != F.col("main")) & ~F.col("pivot")).select("region", "id", "n")
    few = (F.count(F.lit(1)) <= open_rows) & (F.sum("n") <= cell_shingles)
    open_ = saved(open_.join(open_.groupBy("region").agg(few.alias("few")), "region").select("region", "id", "few"))

    lone = sets.join(open_.where("few").select("region", "id").distinct(), ["region", "id"], "left_semi")
    asked = sets.join(open_.where("few").select("region").distinct(), "region", "left_semi")
    settled = _measured(asked, lone).where(linked).select(F.col("id").alias("a"), F.col("pivot").alias("b"))

    far = measured.withColumn("d", 1 - F.col("c") / F.col("u")).join(open_.where("not few").select("region").distinct(), "region", "left_semi")
    near = far.groupBy("region", "id").agg(F.min(F.struct("d", "pivot")).alias("x")).select("region", "id", F.col("x.d").alias("nearest"), F.col("x.pivot").alias("home"))
    homes = near.join(open_, ["region", "id"], "left_semi").groupBy("region", F.col("home").alias("pivot")).agg(F.max("nearest").alias("wide"))
    cells = far.join(near, ["region", "id"]).join(homes, ["region", "pivot"])
    cells = cells.where((F.col("d") <= F.col("nearest") + 2 * radius) & (F.col("d") <= F.col("wide") + radius)).select("region", "pivot", "id")
    cells = saved(cells)
    # cells that save little would only copy their rows: such a region stays one cell, named after the region, like those
    # whose sampling rule chose no pivot
    alike = cells.groupBy("region", "pivot").agg(F.count(F.lit(1)).alias("k")).groupBy("region").agg(F.sum(F.col("k") * F.col("k")).alias("k"))
    alike = alike.join(sets.groupBy("region").agg(F.first("held").alias("held")), "region").where("k >= 0.8 * held * held").select("region")
    bare = sets.join(measured.select("region").distinct(), "region", "left_anti").select("region", F.col("region").alias("pivot"), "id")
    bare = bare.union(sets.join(alike, "region", "left_semi").select("region", F.col("region").alias("pivot"), "id"))
    cells = cells.join(alike, "region", "left_anti")
    placed = sets.drop("held", "load").join(saved(cells.union(bare)), ["region", "id"])
    counts = placed.groupBy("region", "pivot").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / cell_rows, F.sum(F.length("s") / 8) / cell_shingles)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = (
        placed.join(counts, ["region", "pivot"])
        .select("region", "pivot", "id", "s", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("region", "pivot", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "s")
    )
    keys = ["region", "pivot", "low", "high"]

    def join(frames):
        for f in per_key(frames, keys):
            found = metric_join([np.frombuffer(s, dtype=np.uint64) for s in f["s"]], part, share)
            ids = f["id"].to_numpy()
            moved = np.flatnonzero(found != np.arange(len(ids)))
            yield pd.DataFrame({"a": ids[moved], "b": ids[found[moved]]})

    rest = pairs.repartition(*keys).sortWithinPartitions(*keys, "id").mapInPandas(join, "a long, b long")
    return to_pivot.union(settled).union(rest)
