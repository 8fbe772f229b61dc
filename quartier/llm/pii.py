"""Personal data: fixed rules, and a semi-Markov conditional random field that
cuts stretches of text into whole entities and single other tokens.

An island is a run of words with a digit or an at sign, joined by single spaces.
Its tokens are runs of digits, of letters, and single other characters. Every
segment of at most ``MAX_TOKENS`` tokens with the outline of an e-mail address,
an IP address, a card or a phone number is a candidate of that type; features of
the whole segment (checksum, digit count, grouping, neighbours) and the learnt
weights give its score, and a dynamic program over tokens picks boundaries and
types together. So two numbers side by side, which the rules run into one and
then drop, come apart.

The weights are learnt from islands in which the rules leave nothing open: all
their matches hold and none is a near miss. Pairs of such islands side by side
and spoilt copies (wrong check digit, octet over 255, too few digits) are added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts

# The kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
#: Tokens of an entity, and characters of an e-mail address.
MAX_TOKENS, MAX_EMAIL = 24, 320
#: Training: about so many documents, and islands of each kind (of none: twice).
TRAIN_DOCS, TRAIN_ISLANDS = 20_000, 300
EPOCHS, RATE, RIDGE = 120, 0.3, 1e-3

_GAP = r"\x20\x09-\x0D"
#: Starts at a word's beginning and never gives back: linear on any text.
_ISLAND = re.compile(rf"(?<![^{_GAP}])[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+"
                     rf"(?:\x20[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+)*+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\x00-\x7F]+|.", re.S)
_DIGITS = re.compile(r"[0-9]+")


def digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)


def _emails(text: str) -> list[tuple[int, int]]:
    out, free = [], 0
    for m in _DOMAIN.finditer(text):
        a = at = m.start()
        while a > free and text[a - 1] in _LOCAL:
            a -= 1
        if a < at:
            out.append((a, m.end()))
            free = m.end()
    return out


def _matches(text: str, islands: list[tuple[int, int]]) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, holds) of all matches of the fixed rules. The first
    three kinds never leave an island."""
    out = []
    for a, b in islands:
        part = text[a:b]
        if "@" in part:
            out += [(0, a + s, a + e, True) for s, e in _emails(part)]
        for m in _IP.finditer(part):
            out.append((1, a + m.start(), a + m.end(), _octets(m.group().split("."))))
        for m in _CARD.finditer(part):
            n = digits(m.group()) if m.end() - m.start() >= 13 else ""
            out.append((2, a + m.start(), a + m.end(), 13 <= len(n) <= 19 and luhn(n)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            out.append((3, m.start(), m.end(), 9 <= len(digits(m.group())) <= 15))
    return out


def islands(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ISLAND.finditer(text)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the fixed rules, in code points, sorted."""
    return sorted(m[:3] for m in _matches(text, islands(text)) if m[3])


# -- segments and their features -----------------------------------------------------

# Features: index by name, in blocks of a kind; the last block is of other tokens.
_NAMES = [
    "email", "email left open", "email right open", "email word domain", "email labels",
    "email short local", "ip", "ip octets", "ip zero", "ip touches letter", "ip touches digit",
    "ip touches dot", "card", "card checksum", "card 16", "card 13-15", "card long", "card whole",
    "card fours", "card uneven", "card touches letter", "card touches digit", "card touches sign",
    "phone", "phone plus", "phone brackets", "phone bracket open", "phone 9-12", "phone 13-15",
    "phone 7-8", "phone groups", "phone end group", "phone long group", "phone touches letter",
    "phone touches digit", "phone touches sign", "other digits", "other long digits",
    "other letters", "other at", "other plus", "other sign"]
_F = {n: i for i, n in enumerate(_NAMES)}
N_FEATURES = len(_NAMES)


def _around(kind: str, left: str, right: str) -> list[int]:
    out = []
    if left.isalpha() or right.isalpha():
        out.append(_F[f"{kind} touches letter"])
    if left.isdigit() or right.isdigit():
        out.append(_F[f"{kind} touches digit"])
    return out


def _email_features(s: str, left: str, right: str) -> list[int]:
    local, domain = s.split("@", 1)
    labels = domain.split(".")
    out = [_F["email"]]
    if left in _LOCAL and left:
        out.append(_F["email left open"])
    if right.isalnum() or right == "-" or right == ".":
        out.append(_F["email right open"])
    if labels[-1].isalpha() and len(labels[-1]) > 1:
        out.append(_F["email word domain"])
    if len(labels) > 1:
        out.append(_F["email labels"])
    if len(local) < 2:
        out.append(_F["email short local"])
    return out


def _ip_features(s: str, left: str, right: str) -> list[int]:
    parts = s.split(".")
    out = [_F["ip"], *_around("ip", left, right)]
    if _octets(parts):
        out.append(_F["ip octets"])
    if any(len(p) > 1 and p[0] == "0" for p in parts):
        out.append(_F["ip zero"])
    if left == "." or right == ".":
        out.append(_F["ip touches dot"])
    return out


def _card_features(s: str, left: str, right: str) -> list[int]:
    groups = _DIGITS.findall(s)
    n = "".join(groups)
    out = [_F["card"], *_around("card", left, right)]
    if luhn(n):
        out.append(_F["card checksum"])
    out.append(_F["card 16" if len(n) == 16 else "card 13-15" if len(n) < 16 else "card long"])
    if len(groups) == 1:
        out.append(_F["card whole"])
    elif all(len(g) == 4 for g in groups[:-1]):
        out.append(_F["card fours"])
    else:
        out.append(_F["card uneven"])
    if left in ".-+()/:" and left or right in "-" and right:
        out.append(_F["card touches sign"])
    return out


def _phone_features(s: str, left: str, right: str) -> list[int]:
    groups = _DIGITS.findall(s)
    n = sum(map(len, groups))
    out = [_F["phone"], *_around("phone", left, right)]
    if s[0] == "+":
        out.append(_F["phone plus"])
    if s.count("(") != s.count(")"):
        out.append(_F["phone bracket open"])
    elif "(" in s:
        out.append(_F["phone brackets"])
    out.append(_F["phone 7-8" if n < 9 else "phone 9-12" if n < 13 else "phone 13-15"])
    if 2 <= len(groups) <= 6:
        out.append(_F["phone groups"])
    if 3 <= len(groups[-1]) <= 5:
        out.append(_F["phone end group"])
    if max(map(len, groups)) > 11:
        out.append(_F["phone long group"])
    if left in ".-+()" and left or right in "-" and right:
        out.append(_F["phone touches sign"])
    return out


_FEATURES = (_email_features, _ip_features, _card_features, _phone_features)


def _other_features(token: str) -> list[int]:
    if token[0].isdigit() and token.isascii():
        return [_F["other digits"], _F["other long digits"]] if len(token) > 8 \
            else [_F["other digits"]]
    if token.isalpha():
        return [_F["other letters"]]
    return [_F["other at" if token == "@" else "other plus" if token == "+" else "other sign"]]


def _outlines(tokens: list[str], cuts: list[int]) -> Iterator[tuple[int, int, int]]:
    """(kind, first token, end token) of every candidate segment."""
    n = len(tokens)
    for a, t in enumerate(tokens):
        last = min(n, a + MAX_TOKENS)
        if t == "@":
            starts = []
            for s in range(a - 1, max(-1, a - MAX_TOKENS), -1):
                if not (tokens[s].isascii() and tokens[s][0] in _LOCAL):
                    break
                if tokens[s].isalnum():
                    starts.append(s)
            for b in range(a + 1, min(n, a + MAX_TOKENS)):
                u = tokens[b]
                if not (u.isascii() and (u.isalnum() or u in ".-")):
                    break
                if u == "." and tokens[b - 1] in ("@", "."):
                    break
                if u.isalnum() and "." in tokens[a + 1:b]:
                    for s in starts:
                        if b + 1 - s <= MAX_TOKENS and cuts[b + 1] - cuts[s] <= MAX_EMAIL:
                            yield 0, s, b + 1
            continue
        number = t[0] in "0123456789"
        if number and a + 7 <= n and tokens[a + 1] == tokens[a + 3] == tokens[a + 5] == "." \
                and all(tokens[a + k][0] in "0123456789" for k in (2, 4, 6)):
            yield 1, a, a + 7
        if number:
            b, count = a, 0
            while b < last and tokens[b][0] in "0123456789":
                count += len(tokens[b])
                if count > 19:
                    break
                if count >= 13:
                    yield 2, a, b + 1
                if b + 1 >= last or tokens[b + 1] not in (" ", "-"):
                    break
                b += 2
        if number or t == "+" or t == "(":
            count = 0
            for b in range(a, last):
                u = tokens[b]
                if u[0] in "0123456789":
                    count += len(u)
                    if count > 15:
                        break
                    if count >= 7 and (t == "+" or b > a):
                        yield 3, a, b + 1
                elif u not in (" ", "(", ")", ".", "-") and not (b == a and u == "+"):
                    break


class Lattice:
    """Segments of an island: ``segs`` (kind or -1, first token, end token) and
    their features, and the tokens' offsets ``cuts``."""

    def __init__(self, text: str):
        self.text = text
        tokens = _TOKEN.findall(text)
        cuts = [0]
        for t in tokens:
            cuts.append(cuts[-1] + len(t))
        self.cuts, self.n = cuts, len(tokens)
        self.segs: list[tuple[int, int, int]] = []
        self.features: list[list[int]] = []
        for i, t in enumerate(tokens):
            self.segs.append((-1, i, i + 1))
            self.features.append(_other_features(t))
        for kind, a, b in dict.fromkeys(_outlines(tokens, cuts)):
            s, e = cuts[a], cuts[b]
            self.segs.append((kind, a, b))
            self.features.append(_FEATURES[kind](text[s:e], text[s - 1:s] if s else "",
                                                 text[e:e + 1]))


def decode(text: str, weights: list[float]) -> list[tuple[int, int, int]]:
    """The best segmentation's entities of an island as (kind, start, end).

    Candidates are scored as they come, in the order of their tokens, and only
    the best way to each token is kept: memory is that of the tokens."""
    tokens = _TOKEN.findall(text)
    cuts = [0]
    for t in tokens:
        cuts.append(cuts[-1] + len(t))
    n = len(tokens)
    best, back = [0.0] + [-np.inf] * n, [(-1, -1)] * (n + 1)
    found, at = False, 0

    def others(upto: int, at: int) -> int:
        """Single tokens as far as every way to ``upto`` is known."""
        for i in range(at, upto):
            s = best[i] + sum(weights[f] for f in _other_features(tokens[i]))
            if s > best[i + 1]:
                best[i + 1], back[i + 1] = s, (-1, i)
        return max(at, upto)

    for kind, i, j in _outlines(tokens, cuts):
        # no segment that is still to come ends at or before token i
        at = others(i, at)
        s, e = cuts[i], cuts[j]
        score = best[i] + sum(weights[f] for f in _FEATURES[kind](
            text[s:e], text[s - 1:s] if s else "", text[e:e + 1]))
        found = True
        if score > best[j]:
            best[j], back[j] = score, (kind, i)
    if not found:
        return []
    others(n, at)
    out, j = [], n
    while j:
        kind, i = back[j]
        if kind >= 0:
            out.append((kind, cuts[i], cuts[j]))
        j = i
    return out[::-1]


# -- training --------------------------------------------------------------------------

Labelled = tuple[str, list[tuple[int, int, int]]]


class Pack:
    """Lattices side by side, for passes over all of them at once."""

    def __init__(self, rows: list[Labelled]):
        start, end, owner, gold, step, feats = [], [], [], [], [], []
        self.first, self.last, node = [], [], 0
        for text, spans in rows:
            lat = Lattice(text)
            want = {(k, s, e) for k, s, e in spans}
            covered = {p for _, s, e in spans for p in range(s, e)}
            for (k, a, b), f in zip(lat.segs, lat.features):
                s, e = lat.cuts[a], lat.cuts[b]
                start.append(node + a)
                end.append(node + b)
                step.append(b)
                owner.append(len(self.first))
                gold.append((k, s, e) in want if k >= 0 else s not in covered)
                feats.append(f)
            self.first.append(node)
            self.last.append(node + lat.n)
            node += lat.n + 1
        self.n_nodes = node
        self.start, self.end, self.owner = (np.array(x, np.int64) for x in (start, end, owner))
        self.gold = np.array(gold, float)
        self.matrix = np.zeros((len(feats), N_FEATURES))
        for i, f in enumerate(feats):
            self.matrix[i, f] = 1.0
        step, begin = np.array(step, np.int64), self.start - np.array(self.first)[self.owner]
        self.by_end = [np.flatnonzero(step == k) for k in range(1, step.max(initial=0) + 1)]
        self.by_start = [np.flatnonzero(begin == k) for k in range(begin.max(initial=-1), -1, -1)]

    def gradient(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Log-likelihood of the gold segmentations and its gradient."""
        score = self.matrix @ weights
        fwd = np.full(self.n_nodes, -np.inf)
        bwd = np.full(self.n_nodes, -np.inf)
        fwd[self.first] = 0.0
        bwd[self.last] = 0.0
        for i in self.by_end:
            np.logaddexp.at(fwd, self.end[i], fwd[self.start[i]] + score[i])
        for i in self.by_start:
            np.logaddexp.at(bwd, self.start[i], bwd[self.end[i]] + score[i])
        z = fwd[self.last]
        p = np.exp(fwd[self.start] + score + bwd[self.end] - z[self.owner])
        return float(self.gold @ score - z.sum()), self.matrix.T @ (self.gold - p)


def fit(rows: list[Labelled]) -> np.ndarray:
    """Weights of labelled islands; types that no row has are never found."""
    pack, weights = Pack(rows), np.zeros(N_FEATURES)
    m = v = np.zeros(N_FEATURES)
    for step in range(1, EPOCHS + 1):
        g = pack.gradient(weights)[1] / max(len(rows), 1) - RIDGE * weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        weights = weights + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    seen = {k for _, spans in rows for k, _, _ in spans}
    for k, name in enumerate(KINDS):
        if k not in seen:
            weights[_F[name]] = -1e9
    return weights


def _spoilt(text: str, kind: int) -> str | None:
    """A copy that the rules would not take for the entity."""
    if kind == 1:
        head, tail = text.split(".", 1)
        return f"{int(head[-3:]) % 700 + 256}.{tail}"
    if kind == 2:
        return text[:-1] + str((int(text[-1]) + 1) % 10)
    if kind == 3:
        n = digits(text)
        cut = text[:2 + len(text) * 6 // max(len(n), 1)]
        return cut.rstrip("() .-") if len(digits(cut)) < 9 else None
    return None


def enlarge(rows: list[Labelled]) -> list[Labelled]:
    """The rows, pairs of entity islands side by side, and spoilt copies."""
    whole = [r for r in rows if len(r[1]) == 1 and r[1][0][1:] == (0, len(r[0]))]
    out = list(rows)
    by_kind = {k: [r for r in whole if r[1][0][0] == k] for k in range(len(KINDS))}
    for k, left in by_kind.items():
        for i, (a, sa) in enumerate(left):
            right = by_kind[(k + 1 + i) % len(KINDS)]
            if right:
                b, sb = right[i % len(right)]
                shift = len(a) + 1
                out.append((f"{a} {b}", sa + [(j, s + shift, e + shift) for j, s, e in sb]))
            if i % 2 == 0 and (bad := _spoilt(a, k)):
                out.append((bad, []))
    return out


def clean_islands(text: str) -> Iterator[Labelled]:
    """Islands in which the rules leave nothing open, with their spans."""
    spots = islands(text)
    found = _matches(text, spots)
    for a, b in spots:
        inside = [m for m in found if m[1] < b and m[2] > a]
        if any(not ok and (k != 2 or len(digits(text[s:e])) >= 13) for k, s, e, ok in inside):
            continue
        spans = sorted((s - a, e - a, k) for k, s, e, ok in inside if ok)
        if any(s < 0 or e > b - a for s, e, _ in spans) or \
                any(x[1] > y[0] for x, y in zip(spans, spans[1:])):
            continue
        yield text[a:b], [(k, s, e) for s, e, k in spans]


def train(docs: DataFrame) -> np.ndarray:
    """Weights from a bounded sample: about TRAIN_DOCS documents by hash, and of
    their clean islands TRAIN_ISLANDS of each set of kinds, by hash."""
    docs = texts(docs)
    n = docs.count()
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    some = docs if n <= TRAIN_DOCS else docs.filter(share < int((1 << 30) * TRAIN_DOCS / n))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {(island, ",".join(f"{k}:{s}:{e}" for k, s, e in spans))
                    for text in batch["text"] for island, spans in clean_islands(text)
                    if len(island) <= MAX_EMAIL}
            yield pd.DataFrame(sorted(rows), columns=["island", "spans"])

    found = some.select("text").mapInPandas(emit, "island string, spans string").distinct()
    kinds = F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(
        "spans", F.lit(r"(?:^|,)([0-9]):"), F.lit(1)))), ""), F.lit(""))
    found = found.withColumn("kinds", kinds).filter(F.length("kinds") <= 1)
    rank = F.row_number().over(Window.partitionBy("kinds").orderBy(F.xxhash64("island"), "island"))
    found = found.withColumn("rank", rank).filter(
        F.col("rank") <= F.when(F.col("kinds") == "", 2 * TRAIN_ISLANDS).otherwise(TRAIN_ISLANDS))
    rows = []
    for r in found.orderBy("kinds", "rank").collect():
        spans = [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x]
        rows.append((r["island"], spans))
    return fit(enlarge(rows))


# -- spans of a document -----------------------------------------------------------------

def spans(text: str, weights: list[float]) -> tuple[list, list]:
    """(base spans, all spans) as sorted (kind, start, end) in code points."""
    spots = islands(text)
    base = sorted(m[:3] for m in _matches(text, spots) if m[3])
    found = set(base)
    for a, b in spots:
        if b - a < 7:          # shorter than any entity
            continue
        found.update((k, a + s, a + e) for k, s, e in decode(text[a:b], weights))
    return base, sorted(found)


def _join(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in found)


_OUT = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
        "spans string")


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per row: doc_id, counts of base spans by kind, ``base`` and ``spans``
    (kind:start:end, comma-joined; code points, end exclusive).

    A null or empty text has no span; rows of null or equal doc_id are judged
    one by one; texts of any length are read whole in linear time; other columns
    are ignored; an empty table gives an empty result.
    """
    w = [float(x) for x in weights]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, full = spans(text, w) if text else ([], [])
                counts = [0] * len(KINDS)
                for k, _, _ in base:
                    counts[k] += 1
                out.append((*counts, _join(base), _join(full)))
            res = pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base",
                                             "spans"])
            res.insert(0, "doc_id", batch["doc_id"].array)
            yield res

    # pandas would turn ids with nulls into floats
    rows = texts(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (rows.mapInPandas(judge, _OUT.replace("doc_id long", "doc_id string"))
            .withColumn("doc_id", F.col("doc_id").cast("long")))

