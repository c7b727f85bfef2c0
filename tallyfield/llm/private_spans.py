"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for what they miss."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, named, slices

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")

# ------------------------------------------------------------------ fixed patterns

# none of them looks at a character more than a few times, however long a run of letters or digits is
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_OTHER = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def small_parts(s: str) -> bool:
    """Whether all groups of digits are 255 at most."""
    return all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in _OTHER.split(s) if x)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, leftmost and non-overlapping for each kind; a match that
    fails its check is dropped, and the search goes on behind it."""
    out, at, done = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if small_parts(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _OTHER.sub("", m.group())) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_OTHER.sub("", m.group())) <= 15]
    return sorted(out)


# ------------------------------------------------------------------ zones and segments

#: Nothing without a digit, an @ or a written "at" can be an entity; zones are what lies around these.
_HIT = re.compile(r"[0-9]+|@|[\[({<]\s?(?:at|AT)\s?[\])}>]|\s(?:at|AT)\s(?=\S{1,40}\s(?:dot|DOT)\s)")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
MOST_TOKENS, MOST_CHARS, LEAST_DIGITS = 28, 72, 7
MARGIN = MOST_CHARS


def zones(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of the text that may hold an entity outside the taken spans. Hits with no more than two margins
    between them share a zone, so zones don't overlap and no segment reaches beyond one."""
    groups: list[list] = []
    k, floor = 0, 0
    taken = sorted(taken)
    for m in _HIT.finditer(text):
        while k < len(taken) and taken[k][2] <= m.start():
            floor = max(floor, taken[k][2])
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        digits = m.end() - m.start() if m.group()[0].isdigit() else 0
        if groups and m.start() - groups[-1][1] <= 2 * MARGIN and floor <= groups[-1][1] and "\n" not in text[groups[-1][1] : m.start()]:
            groups[-1][1] = m.end()
            groups[-1][2] += digits
            groups[-1][3] |= not digits
        else:
            groups.append([m.start(), m.end(), digits, not digits, floor])
    out = []
    starts = [s for s, _, _ in taken]
    for low, high, digits, at, floor in groups:
        if digits < LEAST_DIGITS and not at:
            continue
        left, right = max(low - MARGIN, floor, 0), min(high + MARGIN, len(text))
        left = max(left, text.rfind("\n", left, low) + 1)
        cut = text.find("\n", high, right)
        right = cut if cut >= 0 else right
        after = int(np.searchsorted(starts, high))
        out.append((left, min(right, starts[after]) if after < len(starts) else right))
    return out


class Zone:
    """The tokens of a zone and the segments in it that can be entities: at most ``MOST_TOKENS`` tokens and
    ``MOST_CHARS`` characters that cut no word or number, and either around an "at" or of ``LEAST_DIGITS``
    digits without a letter."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = [m.span() for m in _TOKEN.finditer(text)]
        kinds = "".join(self._kind(text[a:b]) for a, b in self.tokens)
        ats = [m.span() for m in _HIT.finditer(text) if not m.group()[0].isdigit()]
        self.segments: list[tuple[int, int]] = []
        n = len(self.tokens)
        for i in range(n):
            if kinds[i] not in "DW+([" or i and kinds[i - 1] in "DW" and kinds[i] in "DW":
                continue
            start, digits, letters = self.tokens[i][0], 0, False
            for j in range(i, min(i + MOST_TOKENS, n)):
                a, b = self.tokens[j]
                if b - start > MOST_CHARS:
                    break
                digits += b - a if kinds[j] == "D" else 0
                letters |= kinds[j] == "W"
                if kinds[j] not in "DW" or j + 1 < n and kinds[j + 1] in "DW":
                    continue
                around = any(start < x and y < b for x, y in ats)
                if around and kinds[i] in "DW" or digits >= LEAST_DIGITS and not letters:
                    self.segments.append((i, j + 1))

    @staticmethod
    def _kind(token: str) -> str:
        return "D" if "0" <= token[0] <= "9" else "W" if token[0].isalpha() else " " if token[0].isspace() else token[0]

    def span(self, segment: tuple[int, int]) -> tuple[int, int]:
        return self.tokens[segment[0]][0], self.tokens[segment[1] - 1][1]

    def features(self, segment: tuple[int, int]) -> list[str]:
        """Features of the whole segment: its shape, its digits, its checks and what stands around it."""
        a, b = self.span(segment)
        s = self.text[a:b]
        digits = _OTHER.sub("", s)
        groups = [x for x in _OTHER.split(s) if x]
        marks = "".join(sorted(set(re.sub(r"[^\W_]+", "", s))))
        plain = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", s))
        words = [w.lower() for w in re.findall(r"[^\W\d_]+", s)]
        before, after = self.text[:a].rstrip(), self.text[b:].lstrip()
        previous, following = re.findall(r"[^\W_]+$", before[-24:]), re.findall(r"^[^\W_]+", after[:24])
        out = [
            "bias", f"shape {plain[:40]}", f"groups {'-'.join(str(len(g)) for g in groups)[:24]}", f"number of groups {min(len(groups), 9)}",
            f"digits {min(len(digits), 22)}", f"marks {marks[:10]}", f"first {self._kind(s)} {'@' in s}", f"tokens {min(segment[1] - segment[0], 20) // 2}",
            f"touches {self.text[a - 1 : a].strip()!r}", f"touched {self.text[b : b + 1].strip()!r}",
        ]
        if 14 <= len(digits) <= 19:
            out.append(f"luhn {luhn(digits)}")
        if len(groups) == 4:
            out.append(f"small parts {small_parts(s)} {len(words) > 0}")
        if words:
            loose = len(re.findall(r"(?<![\])}>@.])\s(?![\[({<@.])", re.sub(r"\s(?:at|AT|dot|DOT)\s", "@", s)))
            out += [f"loose spaces {min(loose, 3)}", f"dots {min(s.count('.') + len(re.findall('dot|DOT', s)), 4)}", f"last word {min(len(words[-1]), 8)}"]
            out.append(f"ats {min(len(re.findall('@|[^a-zA-Z](?:at|AT)[^a-zA-Z]', s)), 3)}")
        else:
            out += [f"exact {re.sub(r'[0-9]', '9', s)[:32]}", f"spaces {min(sum(c.isspace() for c in s), 4)}"]
        out += [f"previous {w.lower()}" for w in previous] + [f"next {w.lower()}" for w in following]
        return out


# ------------------------------------------------------------------ the random field


def log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def chains(ends: dict, scores, adjacent: float, n: int):
    """The forward sums of a zone: for each boundary the log of the weights of all segmentations up to it, of
    those whose last segment is a token outside entities, and of those where it is an entity. ``ends`` has for
    each boundary the segments (number, start) that end there, ``scores`` the log weight of each over all kinds."""
    out, ent = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1)
    for j in range(1, n + 1):
        out[j] = log_add(out[j - 1], ent[j - 1])
        for c, i in ends.get(j, ()):
            ent[j] = log_add(ent[j], scores[c] + log_add(out[i], ent[i] + adjacent))
    return out, ent


class Field:
    """A semi-Markov conditional random field over the segmentations of a zone.

    A segmentation cuts the tokens into entities, each a segment with a kind, and single tokens outside. Its
    score is the sum of its entities' scores (weights of whole-segment features by kind) and of a weight for
    each two entities without a token between; probabilities are normalised over all segmentations.
    """

    def __init__(self, names: list[str]):
        self.index = {x: k for k, x in enumerate(names)}
        self.weights = np.zeros((len(KINDS), len(names)))
        self.adjacent = 0.0

    def scores(self, zone: Zone) -> np.ndarray:
        """(kinds, segments)"""
        out = np.zeros((len(KINDS), len(zone.segments)))
        for c, segment in enumerate(zone.segments):
            known = [k for x in zone.features(segment) if (k := self.index.get(x)) is not None]
            out[:, c] = self.weights[:, known].sum(axis=1)
        return out

    def best(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the entities of the best segmentation, by dynamic programming over segment ends."""
        zone = Zone(text)
        if not zone.segments or not self.index:
            return []
        scores = self.scores(zone)
        kind, top = scores.argmax(axis=0), scores.max(axis=0)
        ends: dict[int, list] = {}
        for c, (i, j) in enumerate(zone.segments):
            ends.setdefault(j, []).append((c, i))
        n = len(zone.tokens)
        # for each boundary the best score with the last token outside, and with an entity before it
        out, ent, came = [0.0] + [-math.inf] * n, [-math.inf] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            out[j] = max(out[j - 1], ent[j - 1])
            for c, i in ends.get(j, ()):
                x = top[c] + max(out[i], ent[i] + self.adjacent)
                if x > ent[j]:
                    ent[j], came[j] = x, c
        found, j, inside = [], n, ent[n] > out[n]
        while j > 0:
            if inside:
                c = came[j]
                i = zone.segments[c][0]
                a, b = zone.span(zone.segments[c])
                found.append((a, int(kind[c]), b))
                j, inside = i, ent[i] + self.adjacent > out[i]
            else:
                j, inside = j - 1, ent[j - 1] > out[j - 1]
        return found[::-1]


def fit_field(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 60, rate: float = 0.25, decay: float = 0.02, least: int = 3) -> Field:
    """Maximum likelihood by gradient ascent over all zones (text, entities) at a time, with squared
    weights held down. Zones whose entities are no segments that the field considers are left out."""
    held = []
    for text, entities in examples:
        zone = Zone(text)
        place = {zone.span(s): c for c, s in enumerate(zone.segments)}
        if zone.segments and all((a, b) in place for a, _, b in entities):
            held.append((zone, [(k, place[a, b]) for a, k, b in entities]))
    named_ = [[z.features(s) for s in z.segments] for z, _ in held]
    counts: dict[str, int] = {}
    for zone_names in named_:
        for x in {x for names in zone_names for x in names}:
            counts[x] = counts.get(x, 0) + 1
    field = Field(sorted(x for x, n in counts.items() if n >= least))
    if not field.index:
        return field
    lists = [[field.index[x] for x in names if x in field.index] for zone_names in named_ for names in zone_names]
    flat = np.array([k for x in lists for k in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    offset = np.cumsum([0, *[len(z.segments) for z, _ in held]])
    gold = np.zeros((len(KINDS), len(lists)))
    touching = 0
    for (zone, entities), at in zip(held, offset):
        for k, c in entities:
            gold[k, at + c] = 1
        marks = sorted(zone.segments[c] for _, c in entities)
        touching += sum(x[1] == y[0] for x, y in zip(marks, marks[1:]))
    shapes = []
    for zone, _ in held:
        ends, starts = {}, {}
        for c, (i, j) in enumerate(zone.segments):
            ends.setdefault(j, []).append((c, i))
            starts.setdefault(len(zone.tokens) - i, []).append((c, len(zone.tokens) - j))
        shapes.append((ends, starts, len(zone.tokens)))
    mean, square = np.zeros((len(KINDS), len(field.index) + 1)), np.zeros((len(KINDS), len(field.index) + 1))
    for turn in range(1, rounds + 1):
        scores = np.stack([np.bincount(owner, weights=w[flat], minlength=len(lists)) for w in field.weights])
        high = scores.max(axis=0)
        total = high + np.log(np.exp(scores - high).sum(axis=0))
        chance, met = np.zeros(len(lists)), 0.0
        for (zone, _), at, (ends, starts, n) in zip(held, offset, shapes):
            own = total[at : at + len(zone.segments)].tolist()
            out, ent = chains(ends, own, field.adjacent, n)
            back_out, back_ent = chains(starts, own, field.adjacent, n)  # the same read from the right
            norm = log_add(out[n], ent[n])
            for c, (i, j) in enumerate(zone.segments):
                left, right = log_add(out[i], ent[i] + field.adjacent), log_add(back_out[n - j], back_ent[n - j] + field.adjacent)
                chance[at + c] = math.exp(min(0.0, left + own[c] + right - norm))
                if ent[i] > -math.inf:
                    met += math.exp(min(0.0, ent[i] + field.adjacent + own[c] + right - norm))
        expected = np.exp(scores - total) * chance
        away = (gold - expected)[:, owner]
        step = np.stack([np.bincount(flat, weights=w, minlength=len(field.index)) for w in away]) - decay * field.weights * len(held) / 100
        step = np.hstack([step, np.full((len(KINDS), 1), (touching - met) - decay * field.adjacent * len(held) / 100)]) / len(held)
        mean, square = 0.9 * mean + 0.1 * step, 0.99 * square + 0.01 * step**2
        move = rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        field.weights += move[:, :-1]
        field.adjacent += float(move[0, -1])
    return field


# ------------------------------------------------------------------ examples

#: Other ways of writing what the patterns know, and numbers that are no personal data (9: any digit).
_EMAIL_FORMS = [("(at)", "."), ("[at]", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", "."), ("{at}", "."), (" AT ", " DOT ")]
_IP_FORMS = ["[.]", "(.)", " . ", "[.]"]
_CARD_FORMS = [".", "  ", " ", "/", "–", "_"]
_OTHERS = [
    "9999-99-99", "99.99.9999", "9999-99-99 99:99", "9999-99-99 99:99:99", "99/99/9999", "9.999.999,99", "9,999,999.99", "9999999", "99999999", "9999999999", "999999999999",
    "9.999999999", "99.99.99", "9-999-99999-9", "999-9-99-999999-9", "99999-9999", "9999 9999", "999 999 999", "#99999999", "99:99:99.999", "9999–9999", "9.9.9", "9 999 999",
    "9999999999999999999999", "99, 99, 99, 99", "9999, 9999, 9999", "99% 99% 99% 99%", "99.9 99.8 99.7", "9x99x9999",
]


def other_forms(kind: int, s: str, rng) -> str:
    """The entity, written in another way."""
    digits = _OTHER.sub("", s)
    if kind == 0:
        at, dot = _EMAIL_FORMS[rng.integers(len(_EMAIL_FORMS))]
        local, _, domain = s.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return s.replace(".", _IP_FORMS[rng.integers(len(_IP_FORMS))])
    if kind == 2:
        mark = _CARD_FORMS[rng.integers(len(_CARD_FORMS))]
        return mark.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    area, one, two = digits[-10:-7], digits[-7:-4], digits[-4:]
    forms = [
        f"({area}) {one}-{two}", f"{area}-{one}-{two}", f"{area}.{one}.{two}", f"1-{area}-{one}-{two}", f"{digits[:-10]} ({area}) {one}-{two}", f"00{digits[:-10]} {area} {one} {two}",
        f"+{digits[:-10]}/{area}/{one}{two}", f"+{digits[:-10]} {area} {one} {two}", f"0{area}/{one}{two}", f"({area}){one}-{two}",
    ]
    return forms[rng.integers(len(forms))].strip()


def examples_of(found: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The zones as they are, again with their entities in other forms, and with other numbers in their place."""
    rng, out = np.random.default_rng(seed), []
    for text, entities in found:
        out.append((text, entities))
        if not entities:
            continue
        for swap in (other_forms, None):
            parts, marks, at, length = [], [], 0, 0
            for a, k, b in entities:
                new = other_forms(k, text[a:b], rng) if swap else "".join(str(rng.integers(10)) if c == "9" else c for c in _OTHERS[rng.integers(len(_OTHERS))])
                length += a - at
                parts += [text[at:a], new]
                if swap:
                    marks.append((length, k, length + len(new)))
                length, at = length + len(new), b
            out.append(("".join([*parts, text[at:]]), marks))
    return out


def apart(spans: list[tuple[int, int, int]]) -> bool:
    return all(x[2] <= y[0] for x, y in zip(spans, spans[1:]))


def labelled_zones(docs: DataFrame, most: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Zones of the documents and what the patterns find in them, the first ``most`` by a hash."""

    def cut(frames):
        for f in slices(frames, "t"):
            rows = []
            for t in f["t"]:
                spans = base_spans(t) if t else []
                for low, high in zones(t, []) if t else []:
                    inside = [(a - low, k, b - low) for a, k, b in spans if low <= a and b <= high]
                    if high - low <= 8 * MARGIN and apart(inside) and len(inside) == sum(a < high and b > low for a, _, b in spans):
                        rows.append((t[low:high], [x for s in inside for x in s]))
            yield pd.DataFrame(rows, columns=["zone", "spans"])

    found = docs.mapInPandas(cut, "zone string, spans array<int>").dropDuplicates(["zone"])
    held = found.orderBy(F.xxhash64("zone"), "zone").limit(most).collect()
    return [(r["zone"], [tuple(r["spans"][k : k + 3]) for k in range(0, len(r["spans"]), 3)]) for r in held]


def train_field(df: DataFrame, id_column: str = "doc_id", text: str = "text", fit_docs: int = 20_000, fit_zones: int = 1200) -> Field:
    """A field learned from what the patterns find. The sample is bounded: ``fit_docs`` documents, picked
    by a hash of id and text, and ``fit_zones`` of their zones, each of some hundred characters."""
    docs = df.select(F.col(named(id_column)).alias("i"), F.col(named(text)).alias("t")).where("t is not null")
    parts = 1_000_000
    share = min(parts, -(-parts * fit_docs // max(1, docs.count())))
    return fit_field(examples_of(labelled_zones(docs.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) < share), fit_zones)))


# ------------------------------------------------------------------ the operator


def all_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """What the patterns find, and what the field adds beside it."""
    base = base_spans(text)
    added = []
    for low, high in zones(text, base):
        added += [(a + low, k, b + low) for a, k, b in field.best(text[low:high])]
    return base, added


def find_private(df: DataFrame, id_column: str = "doc_id", text: str = "text", **fit) -> DataFrame:
    """The table with the column ``private`` added, in place of one of this name: an array of (kind, start, end,
    base) by start, then kind as listed in ``KINDS``; offsets are code points, ends exclusive.

    ``base`` spans are those of the fixed patterns. The others come from a semi-Markov conditional random field,
    trained on a bounded sample (see ``train_field``) of what the patterns find, also written in other
    ways, against other numbers. It segments the stretches between base spans that have digits or an "at", at
    most ``MOST_TOKENS`` tokens an entity. Where the sample holds no personal data it adds nothing.

    Texts are read whole, very long ones too; a null or empty text has no spans. Repeated rows, and rows that share an
    id or have none, are searched each. An empty table gives an empty result; other columns stay as they are.
    """
    field = train_field(df, id_column, text, **fit)
    if not field.weights.any():
        field = Field([])

    @F.pandas_udf("array<struct<kind string, start int, end int, base boolean>>")
    def search(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            base, added = all_spans(t, field) if t else ([], [])
            rows = sorted([(a, k, b, True) for a, k, b in base] + [(a, k, b, False) for a, k, b in added])
            out.append([{"kind": KINDS[k], "start": a, "end": b, "base": x} for a, k, b, x in rows])
        return pd.Series(out, dtype=object)

    held = fresh(df, "private")
    rows = df.withColumn(held, search.asNondeterministic()(F.col(named(text))))
    return rows.select(*[F.col(named(c)) for c in df.columns if c.lower() != "private"], F.col(held).alias("private"))
