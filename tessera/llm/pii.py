"""Personal data: candidate spans scored by gradient-boosted trees.

Base spans (email, ip, card, phone) follow fixed patterns with their checks and
always stay. Beside them high-recall generators propose overlapping spans:
anything like an address with an obfuscated or spaced @ (of any length, also one that begins in
the host of another), any dotted quad or
colon-separated hex groups, and, in runs of digit groups with separators, every sub-span
at group borders that holds a plausible number of digits (``DIGITS``) in ``GROUPS`` groups at most, or is
the whole run; so a number is found beside others that it runs together with, and a start
has a bounded number of spans. Boosted trees score each candidate by its format (digits, groups, separators,
checks) and its context (words, characters and digit groups around it).

No table has labels for personal data, so the trees learn from what the base
rules settle: of all candidates of every different text (copies count once) those that
are base spans are positive and those that fail the checks negative. Every positive is
also shown in a rewritten form (plus and country code dropped, separators
changed, @ spelled out) and every negative with the same rewriting, so the
trees score forms that the patterns miss; numbers are also shown beside another number, where the spans that
cut them or take too much are negatives; each comes with decoys (dates, version
numbers, wrong check digits, too few or too many digits, "at" between plain
words), whose candidates are negatives. The trees learn from the candidates of two thirds of
these texts; all those of the other third, chosen by a hash of the text, set, per kind, the lowest
threshold that keeps ``PRECISION`` on rewritten and plain candidates; a kind
without enough positives adds nothing.

Spark does the learning on written tables: exact quantiles cut the features into bins,
equal binned candidates become one row with its count, and each level of a tree is one
aggregate of gradients by bin, for all kinds at once. The gradients are summed
as whole numbers, so the trees don't depend on how Spark deals the rows; the driver
sees one histogram a node.

Selection goes by score; a span that overlaps a base span or a better one is
left out. Offsets are code points, end exclusive.

Defined cases: null texts count as empty and hold nothing; repeated rows are
judged alike; very long texts are read whole; empty tables give empty tables;
extra columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import add_text_columns, ship, shipped, text_bytes
from tessera.session import materialize

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_POSITIVES = 10
ROUNDS, LEVELS, RATE, BINS = 40, 3, 0.3, 16
QUANTILES = [i / BINS for i in range(1, BINS)]
UNIT = 1 << 24  # gradients are summed in whole parts of this
BLOCK, PACKED = 4096, 1 << 16  # candidates of a written block: as described, binned

# The base patterns, as they run in linear time. An email is found from its @ (``_emails``);
# an ip's numbers are whole runs of digits, so it starts at none's middle and gives no digit back.
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

_AT = r"(?:@|\[at\]|\(at\)|\{at\}|\x20at\x20)"
_DOT = r"(?:\.|\x20?(?:\[dot\]|\(dot\)|\{dot\})\x20?|\x20dot\x20)"
GENERATORS = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)\x20?{_AT}\x20?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+"),
    "ip": re.compile(r"[0-9]{1,6}(?:\.[0-9]{1,6}){3,5}|(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}"),
    "card": re.compile(r"[0-9]++(?:[\x20._-]{1,2}[0-9]++)*+"),
    "phone": re.compile(r"[0-9]++(?:[\x20()./-]{1,3}[0-9]++)*+"),
}
#: Digits of a proposed span; groups of one that is not its whole run.
DIGITS = {"card": (12, 19), "phone": (7, 15)}
GROUPS = 7
# Whatever a generator proposes holds one of these: a digit, an at, or hex letters on both sides of a colon.
_MAY_HOLD = re.compile(rf"[0-9]|{_AT}|[A-Fa-f]:[A-Fa-f]")
# Frequent endings of host names.
_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "uk", "it", "nl", "ch", "at"}
_CONTEXT = {
    "email": re.compile(r"mail|contact|write|reach", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login", re.I),
    "card": re.compile(r"card|visa|master|credit|payment|cvv", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|contact|reach", re.I),
}
_GROUP = re.compile(r"[0-9]++")
_LEFT_GROUP, _RIGHT_GROUP = re.compile(r"([0-9]+)[\x20()./_-]{1,3}$"), re.compile(r"[\x20()./_-]{1,3}([0-9]+)")
_AGAINST = re.compile(r"version|\bv\.?$|isbn|order|invoice|ticket|\bid\b|no\.|#$|token|hash|serial|[$€£%]$", re.I)


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    """The check of a base match."""
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or 0) <= 255 for p in found.split("."))
    if kind == "card":
        d = _digits(found)
        return 12 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(_digits(found)) <= 15


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of a local part, an @ and a dotted host, leftmost and not overlapping."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_PART:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            spans.append((start, host.end()))
        free = host.end() if host else at + 1  # no local part reaches over an @
        at = text.find("@", free)
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the base spans, by start, then kind."""
    spans = []
    for k, kind in enumerate(KINDS):
        if kind == "email":
            spans += [(a, k, b) for a, b in _emails(text)]
        elif kind != "phone" or "+" in text:
            spans += [(m.start(), k, m.end()) for m in BASE[kind].finditer(text) if passes(kind, m.group())]
    return sorted(spans)


class Taken:
    """Intervals sorted by start; says whether one of them overlaps another interval."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.reach = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def __call__(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.reach[k - 1] > a


def _number_spans(text: str, kind: str) -> Iterator[tuple[int, int]]:
    """Sub-spans at group borders of every run of digit groups, by the kind's number of digits."""
    least, most = DIGITS[kind]
    for run in GENERATORS[kind].finditer(text):
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        for i, (a, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                if digits > most or j - i >= GROUPS and i:
                    break
                if digits < least or j - i >= GROUPS and j < len(groups) - 1:
                    continue
                b = groups[j][1]
                if kind == "card":
                    yield a, b
                    continue
                opened = a - (text[a - 1:a] == "(")
                yield opened, b
                if text[opened - 1:opened] == "+":
                    yield opened - 1, b


def candidates(text: str, kind: str) -> list[tuple[int, int]]:
    """Spans that the kind's generator proposes, overlapping ones included."""
    if kind in DIGITS:
        return list(_number_spans(text, kind))
    if kind == "ip":
        return [m.span() for m in GENERATORS[kind].finditer(text)]
    spans, m = [], GENERATORS[kind].search(text)
    while m:
        spans.append(m.span())
        m = GENERATORS[kind].search(text, m.end(1))  # a host may be the next one's local part
    return spans


def _plausible(kind: str, found: str, digits: str) -> bool:
    """The kind's ranges, whatever the separators."""
    if kind == "ip":
        return ":" in found or found.count(".") == 3 and passes("ip", found)
    if kind == "card":
        return 12 <= len(digits) <= 19
    return kind == "email" or 9 <= len(digits) <= 15


def describe(text: str, kind: str, a: int, b: int) -> list[float]:
    """Format and context of a candidate."""
    s = text[a:b]
    d = _digits(s)
    groups = [len(g) for g in re.findall(r"[0-9]+", s)]
    left, right = text[max(0, a - 30):a], text[b:b + 12]
    before, after = text[a - 1:a], text[b:b + 1]
    parts = re.split(r"[.:]", s)
    return [
        len(s), len(d), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        s.count("."), s.count("-"), s.count(" "), s.count("("), float(luhn(d)) if d else -1.0,
        max((int(p.lstrip("0")[:4] or 0) for p in parts if p.isascii() and p.isdigit()), default=-1),
        sum(c.isalpha() for c in s), len(re.split(_DOT, s)[-1]), len(set(d)),
        float(re.split(_DOT, s)[-1].strip().lower() in _ENDINGS), float(bool(re.search(r"[\[({]at[\])}]|@", s))),
        len(re.split(_DOT, s)), float(_plausible(kind, s, d)),
        float(before.isalnum()) + 2 * (before in "\"'=/_"), float(after.isalnum()) + 2 * (after in "\"'=/_"),
        float(before in "0123456789.+-") if before else 0.0, float(bool(_CONTEXT[kind].search(left))),
        float(bool(_AGAINST.search(left.rstrip()))), float(bool(_CONTEXT[kind].search(right))),
        len(near_left[1]) if (near_left := _LEFT_GROUP.search(left)) else 0, len(near_right[1]) if (near_right := _RIGHT_GROUP.match(right)) else 0,
        s.count("(") - s.count(")"), int(d[0]) if d else -1, len({c for c in s if not c.isalnum()}),
    ]


def rewritten(text: str, kind: str, a: int, b: int) -> tuple[str, int, int]:
    """The candidate in a form that the base pattern doesn't take, in its own context."""
    s = text[a:b]
    form = zlib.crc32(text[max(0, a - 30):b].encode()) % 4  # which rewriting, fixed by the text
    if kind == "email":
        user, _, host = s.partition("@")
        s = user + (" [at] ", "(at)", " at ", " @ ")[form] + (host.replace(".", (" [dot] ", "(dot)", " dot ", ".")[form]) if form < 3 else host)
    elif kind == "phone":
        s = re.sub(r"^\+[0-9]{0,3}[\x20.-]*", "", s)
        s = (s, re.sub(r"[()]", "", s), "0" + re.sub(r"[^0-9]+", ".", s).strip("."), re.sub(r"[^0-9]+", " ", s).strip())[form]
    elif kind == "card":
        d = _digits(s)
        s = (".", "_", "  ", ". ")[form].join(d[i:i + 4] for i in range(0, len(d), 4))
    near = text[max(0, a - 30):a]
    return near + s + text[b:b + 12], len(near), len(near) + len(s)


def beside(text: str, kind: str, a: int, b: int) -> tuple[str, int, int]:
    """The number next to another one, in its own context."""
    s = text[a:b]
    form = zlib.crc32(text[max(0, a - 30):b].encode()) % 4
    other = ("2024", "7", s.lstrip("+"), _digits(s)[-4:])[form]
    near = text[max(0, a - 30):a]
    if form == 3:
        return f"{near}{s} {other}{text[b:b + 12]}", len(near), len(near) + len(s)
    return f"{near}{other} {s}{text[b:b + 12]}", len(near) + len(other) + 1, len(near) + len(other) + 1 + len(s)


def decoys(text: str, kind: str, a: int, b: int) -> Iterator[tuple[str, int, int]]:
    """Candidates in things of like characters that are no personal data, in the candidate's context."""
    d = (_digits(text[a:b]) or "0") * 16
    if kind == "email":
        forms = ["seen at home.then" + d[0], "look at it.and", f"be at {d[:2]}.{d[2:4]}", "she at noon.of"]
    elif kind == "ip":
        forms = [f"{d[0]}.{d[1]}.{d[2]}.{d[3]}.{d[4]}", f"{300 + int(d[:2])}.{d[2]}.{300 + int(d[3:5])}.{d[5:8]}"]
    elif kind == "card":
        wrong = d[:15] + str((int(d[15]) + 5) % 10)
        wrong = wrong if not luhn(wrong) else wrong[:15] + str((int(wrong[15]) + 1) % 10)
        forms = [wrong, ("._ "[zlib.crc32(wrong.encode()) % 3]).join(wrong[i:i + 4] for i in range(0, 16, 4))]
    else:  # a date, too few digits, too many
        forms = [f"20{d[0]}{d[1]}-0{d[2]}-1{d[3]} 1{d[4]}:{int(d[5:7]) % 60:02d}", f"{d[:3]}.{d[3:5]} / {d[5:8]}.{d[8]}",
                 (". -"[int(d[1]) % 3]).join(d[i:i + 4] for i in range(0, 16, 4))]
    near = text[max(0, a - 30):a]
    for s in forms:
        other = near + s + text[b:b + 12]
        for u, v in candidates(other, kind):
            if u < len(near) + len(s) and len(near) < v:
                yield other, u, v


class Trees:
    """Gradient-boosted regression trees on binned features, logistic loss.

    A tree is full: (feature, last bin that goes left) of its inner nodes, level by
    level, and the values of its leaves. A node that isn't split sends all to the left.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self._begin([np.unique(np.quantile(x[:, j], QUANTILES)) for j in range(x.shape[1])], float(y.mean()))
        columns, ones = np.ascontiguousarray(self.bin(x).T), np.ones(len(y))
        boost({"": self}, lambda: {"": self.sums(columns, y, ones)})

    @classmethod
    def begun(cls, cuts: list[np.ndarray], share: float) -> Trees:
        """No tree yet; ``cuts`` of each feature and the share of positives."""
        trees = cls.__new__(cls)
        trees._begin(cuts, share)
        return trees

    def _begin(self, cuts: list[np.ndarray], share: float) -> None:
        share = min(max(share, 1e-3), 1 - 1e-3)
        self.cuts, self.start, self.level = cuts, float(np.log(share / (1 - share))), 0
        self.split = np.zeros((0, (1 << LEVELS) - 1, 2), np.uint8)
        self.leaf = np.zeros((0, 1 << LEVELS))
        self.growing = np.zeros(self.split.shape[1:], np.uint8)

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)]).astype(np.uint8)

    @staticmethod
    def _nodes(split: np.ndarray, columns: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (a column of ``columns``) after some levels of one tree."""
        at = np.zeros(columns.shape[1], np.uint8)
        for level in range(levels):
            right = np.zeros(len(at), bool)
            for node in range(1 << level):
                feature, last = split[(1 << level) - 1 + node]
                if last < BINS:
                    right |= (at == node) & (columns[feature] > last)
            at = 2 * at + right
        return at

    def sums(self, columns: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradients and their weights by node, feature and bin of the level that grows, then rows by node.

        ``columns`` holds a row of bins for each feature; the sums are whole numbers, so blocks add up exactly.
        """
        z = np.full(len(y), self.start)
        for split, leaf in zip(self.split, self.leaf):
            z += RATE * leaf[self._nodes(split, columns, LEVELS)]
        p = 1 / (1 + np.exp(-z))
        parts = [np.rint((y - p) * UNIT) * weight, np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT) * weight]
        at, nodes = self._nodes(self.growing, columns, self.level).astype(np.intp), 1 << self.level
        out = np.zeros((2, nodes, len(columns), BINS))
        for j, column in enumerate(columns):
            place = at * BINS + column
            for found, part in zip(out, parts):
                found[:, j] = np.bincount(place, part, nodes * BINS).reshape(nodes, BINS)
        rows = np.bincount(at, weight, nodes)
        return np.column_stack([out.reshape(2, -1), [rows, rows]]).astype(np.int64)

    def grow(self, sums: np.ndarray) -> None:
        """Split the nodes of the level that grows by its ``sums``; the last level ends the tree."""
        nodes = 1 << self.level
        found, rows = sums[:, :-nodes].reshape(2, nodes, len(self.cuts), BINS) / UNIT, sums[0, -nodes:]
        leaf = np.zeros(2 * nodes)
        for node in range(nodes):
            gs, hs = found[:, node].cumsum(2)
            g, h = gs[0, -1], hs[0, -1]
            gain = (gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g * g / (h + 1))[:, :-1]
            j, k = np.unravel_index(int(gain.argmax()), gain.shape)
            place = nodes - 1 + node
            if rows[node] < 10 or gain[j, k] <= 1e-3:
                self.growing[place] = 0, BINS
                leaf[2 * node] = g / (h + 1)
            else:
                self.growing[place] = j, k
                leaf[2 * node], leaf[2 * node + 1] = gs[j, k] / (hs[j, k] + 1), (g - gs[j, k]) / (h - hs[j, k] + 1)
        self.level += 1
        if self.level == LEVELS:
            self.split, self.leaf = np.concatenate([self.split, [self.growing]]), np.concatenate([self.leaf, [leaf]])
            self.growing, self.level = np.zeros_like(self.growing), 0

    def of_bins(self, binned: np.ndarray) -> np.ndarray:
        """Probability of rows of bins, in nine digits."""
        out, tree = np.zeros(len(binned)), np.arange(len(self.split))
        for lo in range(0, len(binned), BLOCK):
            part = binned[lo:lo + BLOCK]
            rows, at = np.arange(len(part))[:, None], np.zeros((len(part), len(tree)), np.intp)
            for level in range(LEVELS):
                split = self.split[tree, (1 << level) - 1 + at]
                at = 2 * at + (part[rows, split[..., 0]] > split[..., 1])
            z = self.start + RATE * self.leaf[tree, at].sum(1)
            out[lo:lo + BLOCK] = np.round(1 / (1 + np.exp(-z)), 9)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.of_bins(self.bin(x))


def boost(trees: dict[str, Trees], sums: Callable[[], dict[str, np.ndarray]]) -> None:
    """Grow all ``trees`` together; ``sums()`` adds up the level that grows over all rows."""
    for _ in range(ROUNDS * LEVELS if trees else 0):
        for kind, found in sums().items():
            trees[kind].grow(found)


class Model:
    """Trees and threshold of each kind that had enough to learn from."""

    def __init__(self):
        self.kinds: dict[str, tuple[Trees, float]] = {}

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans), each (start, kind number, end) by start, then kind."""
        if not _MAY_HOLD.search(text):
            return [], []
        base = base_spans(text)
        taken = Taken([(a, b) for a, _, b in base])
        scored = []
        for kind, (trees, threshold) in self.kinds.items():
            proposed = [c for c in candidates(text, kind) if not taken(*c)]
            if proposed:
                p = trees.probability(np.array([describe(text, kind, a, b) for a, b in proposed]))
                scored += [(-q, a, KINDS.index(kind), b) for q, (a, b) in zip(p.tolist(), proposed) if q >= threshold]
        own: list[tuple[int, int, int]] = []  # by start; they never overlap
        for _, a, k, b in sorted(scored):
            at = bisect_left(own, (b,))
            if at == 0 or own[at - 1][2] <= a:
                own.insert(at, (a, k, b))
        return base, sorted(base + own)


class Examples:
    """A written table of described candidates: blocks of one kind, used to learn or (``aside``) for the threshold."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks

    def __len__(self) -> int:
        return self.blocks.agg(F.sum("n")).first()[0] or 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(kind, aside, features or bins, is positive, counts of equal rows if binned) of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            r = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
            y = np.frombuffer(r["y"], np.uint8).astype(float)
            if "weight" in r:
                yield r["kind"], r["aside"], np.frombuffer(r["x"], np.uint8).reshape(-1, len(y)), y, np.frombuffer(r["weight"], np.int64)
            else:
                yield r["kind"], r["aside"], np.frombuffer(r["x"]).reshape(len(y), -1), y, None


def _cuts(blocks: DataFrame) -> dict[str, list[np.ndarray]]:
    """Exact quantiles of every feature, per kind, over all rows of the blocks."""
    def run(batches):
        for kind, _, x, _, _ in _blocks(batches):
            for j in range(x.shape[1]):
                values, n = np.unique(x[:, j], return_counts=True)
                yield pa.RecordBatch.from_pydict({"kind": [kind] * len(n), "feature": pa.array([j] * len(n), pa.int32()), "value": values, "n": n})

    counted = blocks.mapInArrow(run, "kind string, feature int, value double, n long")
    counted = counted.groupBy("kind", "feature", "value").agg(F.sum("n").alias("n")).groupBy("kind", "feature")
    cuts: dict[str, dict[int, np.ndarray]] = {}
    for r in counted.agg(F.percentile("value", QUANTILES, F.col("n")).alias("cuts")).collect():
        cuts.setdefault(r["kind"], {})[r["feature"]] = np.unique(r["cuts"])
    return {kind: [own[j] for j in sorted(own)] for kind, own in cuts.items()}


def _binned(blocks: DataFrame, trees: dict[str, Trees]) -> DataFrame:
    """The blocks as bins, a row of them per feature; equal rows are one with their count."""
    def collapse(batches):
        for kind, aside, x, y, _ in _blocks(batches):
            rows, n = np.unique(np.column_stack([trees[kind].bin(x), y.astype(np.uint8)]), axis=0, return_counts=True)
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(n), "aside": [aside] * len(n), "row": [r.tobytes() for r in rows], "n": n})

    def pack(batches):
        held: dict[tuple[str, bool], tuple[list[bytes], list[int]]] = {}

        def packed(key):
            rows, n = held.pop(key)
            columns = np.ascontiguousarray(np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1).T)
            return pa.RecordBatch.from_pydict({"kind": [key[0]], "aside": [key[1]], "x": [columns[:-1].tobytes()], "y": [columns[-1].tobytes()],
                                               "weight": [np.array(n, np.int64).tobytes()]})

        for batch in batches:
            for kind, aside, row, n in zip(*(c.to_pylist() for c in batch.columns)):
                rows, counts = held.setdefault((kind, aside), ([], []))
                rows.append(row)
                counts.append(n)
                if len(rows) == PACKED:
                    yield packed((kind, aside))
        for key in list(held):
            yield packed(key)

    rows = blocks.mapInArrow(collapse, "kind string, aside boolean, row binary, n long")
    rows = rows.groupBy("kind", "aside", "row").agg(F.sum("n").alias("n"))
    return materialize(rows.mapInArrow(pack, "kind string, aside boolean, x binary, y binary, weight binary"), "pii_binned")


def _level_sums(table: DataFrame, trees: dict[str, Trees]) -> dict[str, np.ndarray]:
    """``Trees.sums`` of every kind over all rows of the table."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for kind, _, columns, y, weight in _blocks(batches):
            total[kind] = total.get(kind, 0) + trees[kind].sums(columns, y, weight)
        for kind, (g, h) in total.items():
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(g), "slot": pa.array(range(len(g)), pa.int32()), "g": g, "h": h})

    found = table.mapInArrow(run, "kind string, slot int, g long, h long").groupBy("kind", "slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    found = found.toArrow().to_pydict()
    kinds, slots, values = np.array(found["kind"]), np.array(found["slot"], np.intp), np.array([found["g"], found["h"]], np.int64)
    out = {}
    for kind in trees:
        own = np.flatnonzero(kinds == kind)
        out[kind] = values[:, own[np.argsort(slots[own])]]
    return out


def _thresholds(table: DataFrame, trees: dict[str, Trees]) -> dict[str, float]:
    """Per kind, the lowest probability from which on ``PRECISION`` of all rows of the table are positive."""
    def run(batches):
        for kind, _, columns, y, weight in _blocks(batches):
            p, place = np.unique(trees[kind].of_bins(np.ascontiguousarray(columns.T)), return_inverse=True)
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(p), "p": p, "good": np.bincount(place, weight * y).astype(np.int64),
                                              "n": np.bincount(place, weight).astype(np.int64)})

    rows = table.mapInArrow(run, "kind string, p double, good long, n long").groupBy("kind", "p").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    # Running sums by slices of the log-odds and within a slice, so that no task sorts a whole kind.
    rows = rows.withColumn("slice", F.floor(8 * F.log((F.col("p") + 1e-9) / (1 - F.col("p") + 1e-9))))
    above = Window.partitionBy("kind").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("kind", "slice").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    slices = slices.select("kind", "slice", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("good", "n")])
    within = Window.partitionBy("kind", "slice").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(slices, ["kind", "slice"])
    rows = rows.select("kind", "p", *[(F.col(f"{c}_above") + F.sum(c).over(within)).alias(c) for c in ("good", "n")])
    return {r["kind"]: r["p"] for r in rows.filter(F.col("good") >= PRECISION * F.col("n")).groupBy("kind").agg(F.min("p").alias("p")).collect()}


def train(examples: Examples) -> Model:
    """A model from all examples."""
    model, blocks = Model(), examples.blocks
    seen = {(r["kind"], r["aside"]): r for r in blocks.groupBy("kind", "aside").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).collect()}
    kinds = [k for k in KINDS if (k, False) in seen and (k, True) in seen
             and min(seen[k, aside]["positive"] for aside in (False, True)) >= LEAST_POSITIVES and seen[k, False]["positive"] < seen[k, False]["n"]]
    if not kinds:
        return model
    blocks = blocks.filter(F.col("kind").isin(kinds))
    cuts = _cuts(blocks.filter(~F.col("aside")))
    trees = {k: Trees.begun(cuts[k], seen[k, False]["positive"] / seen[k, False]["n"]) for k in kinds}
    table = _binned(blocks, trees)
    learned = table.filter(~F.col("aside"))
    boost(trees, lambda: _level_sums(learned, trees))
    for kind, p in _thresholds(table.filter("aside"), trees).items():
        model.kinds[kind] = (trees[kind], max(0.5, p))
    return model


def _example_stream(text: str) -> Iterator[tuple[str, float, list[float]]]:
    """(kind, is positive, features) of the text's candidates and of what is made from them, one after the other."""
    spans = base_spans(text)
    base, taken = {(a, KINDS[k], b) for a, k, b in spans}, Taken([(a, b) for a, _, b in spans])
    for kind in KINDS:
        others = [(a, b) for a, k, b in spans if KINDS[k] != kind]
        starts, reach = [a for a, _ in others], list(accumulate((b for _, b in others), max))
        for a, b in candidates(text, kind):
            before = bisect_right(starts, a)
            inside = before > 0 and reach[before - 1] >= b
            y = float((a, kind, b) in base)
            if inside and not y:
                yield kind, 0.0, describe(text, kind, a, b)  # part of other personal data
                continue
            if not y and taken(a, b):
                continue  # overlaps a positive in part: neither way
            if not y and kind in DIGITS and _plausible(kind, text[a:b], _digits(text[a:b])) and (kind == "phone" or luhn(_digits(text[a:b]))):
                continue  # may be a number that the base pattern ran together with another one, or one without a plus
            yield kind, y, describe(text, kind, a, b)
            shown = [(y, rewritten(text, kind, a, b)), *((0.0, x) for x in decoys(text, kind, a, b))]
            if kind in DIGITS and y:
                forms = [(text, a, b), rewritten(text, kind, a, b)]
                if kind == "card":  # also in fours, which the base pattern takes only where they stand alone
                    near = text[max(0, a - 30):a]
                    forms += [(near + fours + text[b:b + 12], len(near), len(near) + len(fours)) for fours in
                              (mark.join(re.findall("[0-9]{1,4}", _digits(text[a:b]))) for mark in " -")]
                for other, u, v in (beside(other, kind, u, v) for other, u, v in forms):
                    shown.append((1.0, (other, u, v)))
                    twin = _digits(other[u:v])
                    shown += [(0.0, (other, p, q)) for p, q in candidates(other, kind)
                              if (p, q) != (u, v) and p < v and u < q and _digits(other[p:q]) != twin]
            for label, (other, u, v) in shown:
                yield kind, label, describe(other, kind, u, v)


def _examples(text: str) -> list[tuple[str, float, list[float]]]:
    return list(_example_stream(text))


def fit(docs: DataFrame, text: str = "text") -> Model:
    """A model from the candidates of all documents that may hold any."""
    # Copies of a text count once, so that no group of them outweighs the rest.
    texts = docs.filter(F.col(text).rlike(_MAY_HOLD.pattern)).select(F.col(text).alias("text")).distinct()
    texts = texts.select("text", (F.pmod(F.xxhash64("text", F.lit("threshold")), F.lit(3)) == 0).alias("aside"))

    def run(batches):
        held: dict[tuple[str, bool], tuple[array, array]] = {}

        def block(key):
            x, y = held.pop(key)
            return pa.RecordBatch.from_pydict({"kind": [key[0]], "aside": [key[1]], "n": [len(y)], "positive": [sum(y)], "x": [x.tobytes()], "y": [y.tobytes()]})

        for batch in batches:
            for t, aside in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                for kind, y, features in _example_stream(t.decode("utf-8", "replace")):
                    xs, ys = held.setdefault((kind, aside), (array("d"), array("B")))
                    xs.extend(features)
                    ys.append(int(y))
                    if len(ys) == BLOCK:
                        yield block((kind, aside))
        for key in list(held):
            yield block(key)

    blocks = texts.mapInArrow(run, "kind string, aside boolean, n long, positive long, x binary, y binary")
    return train(Examples(materialize(blocks, "pii_examples")))


def _write(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with base counts, ``base_spans`` and ``spans``."""
    sent = ship(docs.sparkSession, fit(docs, text))

    def make():
        model = shipped(sent)

        def find(texts: list[bytes]) -> list:
            both = [model.spans(t.decode("utf-8", "replace")) for t in texts]
            counts = [[sum(s[1] == k for s in base) for base, _ in both] for k in range(len(KINDS))]
            return [*counts, [_write(base) for base, _ in both], [_write(spans) for _, spans in both]]

        return find

    fields = [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
    fields += [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())]
    return add_text_columns(docs, text, fields, make, drop=(text,))


def redact(text: str, spans: list[tuple[int, int, str]], mask: str = "[{}]") -> str:
    """``text`` with the spans (start, kind number, end) replaced; overlapping ones merge."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mask.format(KINDS[k].upper())]
        at = max(at, b)
    return "".join([*out, text[at:]])


