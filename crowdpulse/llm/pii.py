"""Personal data: exact base patterns, widened by a semi-Markov conditional random field.

The base patterns (email, ip, card, phone) are found first and always stay. The field then reads the regions of a text
around digits and at-signs as units (digit runs, letter runs, marks) and scores whole candidate segments: features see
the entire span - digit counts, Luhn sum, octets, separators, cut words, the word before. A region ends only at a newline
or where two words without digits or at-signs follow, however long it gets (an at-sign at its edge brings the word beyond the blank); its segments are scored block by block.
Dynamic programming over segments of at most ``longest`` units chooses boundaries and types together for the whole
region; the entity's length is bounded, the number of entities is not. Spans that the field finds beside the base ones
are added.

The field's weights maximise the conditional likelihood of weak labels - the base spans in a bounded sample of
``sample_rows`` texts, with copies in which they are written differently (phones without plus, country code or brackets,
numbers with other separators, blanks around at-signs), and copies in which dates, amounts, order numbers and the like
stand in their places, labelled as nothing - by forward-backward over the same segments, in the first pieces of each text (long regions are cut between entities to
learn from them, never to find). Without any region to learn from, nothing is added.

Defined cases: null texts are empty and have no spans; positions are code points; repeated rows and null ids are
reported row by row; whole texts are read, in time proportional to their length.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import random
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import fold_docs

# The kinds in their order, and words that announce them.
KINDS = ("email", "ip", "card", "phone")
ANNOUNCE = {"email": {"mail", "email", "e-mail", "contact", "write"}, "ip": {"ip", "host", "server", "address"},
            "card": {"card", "visa", "credit", "karte", "tarjeta", "carte"}, "phone": {"tel", "phone", "call", "fax", "mobile", "telefon"}}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A dotted quad starts at the start of its first run of digits: a later start in the run could only match the same rest.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HAS = re.compile(r"[0-9@]")
UNIT = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_")
#: A token with a digit or at-sign, what joins it to the next one (at most one other word), the word a blank after, and a
#: line's last other word.
LIVE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
JOIN = re.compile(r"[^\S\n]++(?:[^\s0-9@]++[^\S\n]++)?+")
NEXT = re.compile(r"\x20[^\s0-9@]++")
TAIL = re.compile(r"[^\S\n]++[^\s0-9@]++(?=[^\S\n]*+(?:\n|\Z))")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Per at-sign: the longest local part that no match before it took, then the domain."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            taken = m.end()
            yield "email", start, taken
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    if not HAS.search(text):
        return []
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return spans


FEATURES = 37
DATE = re.compile(r"(?<![0-9])(?:(?:1[89]|20)[0-9]{2}[-/.][01]?[0-9][-/.][0-3]?[0-9]|[0-3]?[0-9][-/.][0-3]?[0-9][-/.](?:1[89]|20)[0-9]{2})(?![0-9])")


def span_features(text: str, start: int, end: int, before: str) -> np.ndarray:
    """What a whole segment looks like."""
    s = text[start:end]
    d = digits_of(s)
    n = len(d)
    groups = re.findall(r"[0-9]+", s)
    letters = any(c.isalpha() for c in s)
    x = np.zeros(FEATURES)
    x[0] = 1
    x[1], x[2], x[3], x[4], x[5] = n < 4, 4 <= n < 7, 7 <= n < 9, 9 <= n <= 12, 13 <= n <= 15
    x[6], x[7] = 16 <= n <= 19, n > 19
    x[8] = 13 <= n <= 19 and luhn(d)
    at = s.count("@")
    x[9], x[10] = at == 1, at > 1
    x[11] = at == 1 and bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s))
    quad = len(groups) == 4 and s.count(".") == 3 and " " not in s and not letters
    x[12] = quad and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    x[13] = quad and not x[12]
    x[14], x[15] = s[0] == "+", "(" in s and ")" in s
    x[16], x[17] = "(" in s and ")" not in s, not letters and at > 0
    x[18] = bool(re.fullmatch(r"[0-9 -]+", s))
    x[19] = bool(re.fullmatch(r"[0-9 ().+-]+", s))
    x[20] = len(groups) >= 3
    x[21] = len(groups) == 1
    x[22] = len(groups) >= 3 and all(len(g) == 4 for g in groups[:-1])
    x[23] = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "@._%+-")
    x[24] = end < len(text) and (text[end].isalnum() or text[end] == "@")
    x[25] = end + 1 < len(text) and text[end] in ".-" and text[end + 1].isalnum()
    for i, kind in enumerate(KINDS):
        x[26 + i] = before in ANNOUNCE[kind]
    number = not letters and not at
    x[30] = number and ("," in s or ":" in s)
    x[31] = number and bool(DATE.search(s))
    x[32] = number and s.count(".") == 1 and len(groups) == 2        # a decimal number
    x[33] = number and ("/" in s or "_" in s)
    x[34] = number and len(groups) >= 3 and n in (10, 11, 12) and len(groups[-1]) == 4
    x[35] = number and len(groups) == 2
    x[36] = number and s.startswith("00")
    return x


@dataclass
class Region:
    """Units of a stretch of text, and candidate segments (first unit, unit after the last) in the order of their starts."""
    units: list[tuple[int, int]]
    segments: list[tuple[int, int]]
    features: np.ndarray


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each region, in order; every digit and at-sign stands in one."""
    start = end = -1
    for m in LIVE.finditer(text):
        if end >= 0 and not JOIN.fullmatch(text, end, m.start()):
            yield start, end
            end = -1
        start, end = (start if end >= 0 else _lead(text, m.start())), m.end()
    if end >= 0:
        yield start, end


def _lead(text: str, start: int) -> int:
    """Where the word before an at-sign begins, one blank away; else ``start``."""
    if text[start] != "@" or start < 2 or text[start - 1] != " " or text[start - 2].isspace():
        return start
    at = start - 2
    while at and not text[at - 1].isspace():
        at -= 1
    return at


def units_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    tail = TAIL.match(text, end) or text[end - 1] == "@" and NEXT.match(text, end)
    return [m.span() for m in UNIT.finditer(text, start, tail.end() if tail else end)]


def read_region(text: str, units: list[tuple[int, int]], longest: int, low: int = 0, high: int | None = None) -> Region:
    """The segments that begin at the units from ``low`` to before ``high``, wherever they end."""
    start = units[0][0] if units else 0
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[max(0, start - 30):start].lower())
    first_word = words[-1] if words else ""
    segments, rows = [], []
    for i in range(low, len(units) if high is None else min(high, len(units))):
        a = units[i][0]
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        before = next((text[x:y].lower() for x, y in reversed(units[max(0, i - 3):i]) if text[x].isalpha()), first_word)
        digits, mail, letters = 0, False, False
        for j in range(i, min(len(units), i + longest)):
            x, y = units[j]
            if j > i and x - units[j - 1][1] > 1:
                break
            digits += (y - x) * text[x].isdigit()
            mail, letters = mail or text[x] == "@", letters or text[x].isalpha()
            # letters stand in no number, and in an address only around its at-sign
            if (mail or not letters and (digits >= 7 or digits >= 4 and j - i >= 6)) and text[y - 1].isalnum():
                segments.append((i, j + 1))
                rows.append(span_features(text, a, y, before))
    return Region(units, segments, np.array(rows).reshape(-1, FEATURES))


@dataclass
class Field:
    """Weights per kind and feature, and of an entity that follows another at once."""
    weights: np.ndarray
    adjacent: float
    longest: int = 24

    def _scores(self, r: Region) -> np.ndarray:
        return r.features @ self.weights.T

    def _ending(self, r: Region) -> list[list[int]]:
        at: list[list[int]] = [[] for _ in range(len(r.units) + 1)]
        for k, (_, j) in enumerate(r.segments):
            at[j].append(k)
        return at

    def decode(self, text: str, units: list[tuple[int, int]], block: int = 256) -> list[Span]:
        """The entities of the best segmentation of all units: a single unit outside any entity scores 0. Only the segments
        of ``block`` starting units are held at a time, and one way back for each unit."""
        n = len(units)
        outside, entity = [-math.inf] * (n + 1), [-math.inf] * (n + 1)    # best score up to a unit, by its last segment
        outside[0] = 0.0
        after = bytearray(n + 1)                                            # whether an entity stands before the unit outside
        first, kinds, follows = array("l", [0]) * (n + 1), bytearray(n + 1), bytearray(n + 1)
        for low in range(0, n, block):
            r = read_region(text, units, self.longest, low, low + block)
            scores = self._scores(r)
            top, kind, k = scores.max(axis=1, initial=-math.inf).tolist(), scores.argmax(axis=1).tolist(), 0
            for i in range(low, min(n, low + block)):
                p = entity[i] > outside[i]
                outside[i + 1], after[i + 1] = max(outside[i], entity[i]), p
                enter = entity[i] + self.adjacent
                q = enter > outside[i]
                enter = max(enter, outside[i])
                while k < len(top) and r.segments[k][0] == i:
                    j = r.segments[k][1]
                    if enter + top[k] > entity[j]:
                        entity[j], first[j], kinds[j], follows[j] = enter + top[k], i, kind[k], q
                    k += 1
        out, j, p = [], n, entity[n] > outside[n]
        while j:
            if p:
                i = first[j]
                out.append((KINDS[kinds[j]], units[i][0], units[j - 1][1]))
                j, p = i, follows[j]
            else:
                j, p = j - 1, after[j]
        return out[::-1]

    def expected(self, r: Region) -> tuple[float, np.ndarray, float]:
        """log Z, each segment's and kind's probability, expected adjacent pairs, by forward-backward."""
        scores, ending = self._scores(r), self._ending(r)
        n = len(r.units)
        f = np.full((n + 1, 2), -np.inf)
        f[0, 0] = 0
        for j in range(1, n + 1):
            f[j, 0] = np.logaddexp(*f[j - 1])
            for k in ending[j]:
                i = r.segments[k][0]
                enter = np.logaddexp(f[i, 0], f[i, 1] + self.adjacent)
                f[j, 1] = np.logaddexp(f[j, 1], enter + np.logaddexp.reduce(scores[k]))
        b = np.full((n + 1, 2), -np.inf)
        b[n] = 0
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, _) in enumerate(r.segments):
            starting[i].append(k)
        for i in range(n - 1, -1, -1):
            entity = -np.inf
            for k in starting[i]:
                entity = np.logaddexp(entity, np.logaddexp.reduce(scores[k]) + b[r.segments[k][1], 1])
            b[i, 0] = np.logaddexp(b[i + 1, 0], entity)
            b[i, 1] = np.logaddexp(b[i + 1, 0], entity + self.adjacent)
        z = np.logaddexp(*f[n])
        prob, pairs = np.zeros_like(scores), 0.0
        for k, (i, j) in enumerate(r.segments):
            enter = np.logaddexp(f[i, 0], f[i, 1] + self.adjacent)
            prob[k] = np.exp(enter + scores[k] + b[j, 1] - z)
            if np.isfinite(f[i, 1]):
                pairs += math.exp(f[i, 1] + self.adjacent + np.logaddexp.reduce(scores[k]) + b[j, 1] - z)
        return float(z), prob, pairs


def _rewritten(text: str, spans: list[Span], write) -> tuple[str, list[Span]]:
    """The text with each span's text as ``write`` (kind, text) gives it; the spans follow."""
    out, at, moved = [], 0, []
    size = 0
    for kind, a, z in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        out.append(text[at:a])
        size += a - at
        s = write(kind, text[a:z])
        moved.append((kind, size, size + len(s)))
        out.append(s)
        size += len(s)
        at = z
    return "".join([*out, text[at:]]), moved


def _other_form(rng: random.Random):
    """The same data, written in another way."""
    def write(kind: str, s: str) -> str:
        if kind == "phone":
            s = rng.choice(["", "", "00"]) + s.lstrip("+")
            if rng.random() < 0.5:
                s = re.sub(r"^[0-9]{1,4}[ -](?=[(0-9])", "", s)
            if rng.random() < 0.6:
                s = s.replace("(", "").replace(")", "")
            if rng.random() < 0.8:
                s = re.sub(r"[ -]", rng.choice(" -./"), s)
        elif kind == "card":
            d = digits_of(s)
            s = rng.choice([" ", "-", "."]).join(d[i:i + 4] for i in range(0, len(d), 4)) if rng.random() < 0.5 else s.replace(" ", "-")
        elif kind == "email":
            s = s.replace("@", rng.choice(["@", " @ ", "@ ", " @"]))
        return s
    return write


def _nobodys(rng: random.Random):
    """Numbers of other kinds."""
    def n(digits: int) -> int:
        return rng.randint(10 ** (digits - 1), 10 ** digits - 1)

    def write(kind: str, s: str) -> str:
        year, month, day = rng.randint(1900, 2040), rng.randint(1, 12), rng.randint(1, 28)
        date = rng.choice([f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", f"{month}/{day}/{year}"])
        return rng.choice([
            date, f"{date} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}", f"{date} {n(2)}", f"{date} - {day + 1}.{month}.{year + 1}",
            f"{n(rng.randint(7, 11)):,}", f"{n(rng.randint(7, 11)):,}".replace(",", "."), f"{n(rng.randint(1, 6))}.{n(rng.randint(4, 12))}",
            f"order {n(rng.randint(7, 12))}", f"no. {n(rng.randint(7, 12))}", f"{n(8)}-{n(rng.randint(1, 5))}", f"{n(4)}-{n(4)}",
            f"{n(3)}-{n(3)} {n(2)}", f"{n(1)}.{n(1)}.{n(rng.randint(1, 5))}", f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{n(1)}. {n(2)}. {n(3)}. {n(4)}."])
    return write


def _pieces(text: str, spans: list[Span], longest: int, most: int = 120) -> Iterator[list[tuple[int, int]]]:
    """The units of each region, in pieces of about ``most`` that end outside the spans."""
    inside = [(a, z) for _, a, z in spans]
    for start, end in regions(text):
        units, at = units_of(text, start, end), 0
        while at < len(units):
            cut = min(len(units), at + most)
            for c in range(cut, min(len(units), cut + longest)):
                if not any(a < units[c][0] < z for a, z in inside):
                    cut = c
                    break
            yield units[at:cut]
            at = cut


def learn(texts: list[str], longest: int = 24, epochs: int = 12, rate: float = 0.3, ridge: float = 1e-3, seed: int = 3, copies: int = 4) -> Field:
    """Gradient ascent on the conditional likelihood of the base spans, in the texts and in ``copies`` of either sort."""
    rng = random.Random(seed)
    cases = []
    for text in texts:
        base = base_spans(text)
        versions = [(text, base)]
        for _ in range(copies if base else 0):
            others, _ = _rewritten(text, base, _nobodys(rng))
            versions += [_rewritten(text, base, _other_form(rng)), (others, base_spans(others))]
        for t, spans in versions:
            gold = {(a, z): KINDS.index(k) for k, a, z in reversed(spans)}
            for units in islice(_pieces(t, spans, longest), 40):
                r = read_region(t, units, longest)
                if not r.segments:
                    continue
                picked, free = [], 0
                for k, (i, j) in enumerate(r.segments):
                    kind = gold.get((r.units[i][0], r.units[j - 1][1]))
                    if kind is not None and i >= free:
                        picked.append((k, kind))
                        free = j
                cases.append((r, picked))
    field = Field(np.zeros((len(KINDS), FEATURES)), 0.0, longest)
    field.weights[:, 0] = -2
    grads = np.full_like(field.weights, 1e-6)
    for _ in range(epochs if cases else 0):
        rng.shuffle(cases)
        for r, picked in cases:
            _, prob, pairs = field.expected(r)
            g = -prob.T @ r.features
            for k, kind in picked:
                g[kind] += r.features[k]
            g -= ridge * field.weights
            grads += g * g
            field.weights += rate * g / np.sqrt(grads)
            follow = sum(r.segments[a[0]][1] == r.segments[b[0]][0] for a, b in zip(picked, picked[1:], strict=False))
            field.adjacent += 0.01 * (follow - pairs)
    return field


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that the spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for a, z in sorted((a, z) for _, a, z in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def all_spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans)."""
    if not HAS.search(text):
        return [], []
    base, added = base_spans(text), []
    if field is None:
        return base, added
    known = _merged(base)
    for start, end in regions(text):
        for kind, a, z in field.decode(text, units_of(text, start, end)):
            at = bisect_left(known, (z,)) - 1       # the last base stretch that begins before the entity ends
            if at < 0 or known[at][1] <= a:
                added.append((kind, a, z))
    return base, added


def fit(docs: DataFrame, sample_rows: int = 300) -> Field | None:
    """The field learned from at most ``sample_rows`` documents with digits or at-signs, chosen by a hash of their ids.
    Only ids are ranked; the texts of the chosen few meet in one task, and only the field comes to the driver."""
    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = sorted({t for b in batches for t in b["text"]})
        if texts:
            yield pd.DataFrame({"field": [pickle.dumps(learn(texts))]})

    folded = fold_docs(docs).where("doc_id is not null")
    order = F.xxhash64("doc_id", F.lit(7))
    chosen = folded.where(F.col("text").rlike("[0-9@]")).select("doc_id").orderBy(order, "doc_id").limit(sample_rows).distinct()
    texts = folded.join(F.broadcast(chosen), "doc_id").select("text").repartition(1)
    learned = texts.mapInPandas(train, "field binary").first()
    return pickle.loads(learned["field"]) if learned else None


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; where spans overlap, the first one counts."""
    out, at = [], 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = z
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


FOUND = "struct<n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long>"


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, number of added ones."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(FOUND)
    def seek(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, added = all_spans(t, shared.value)
            counts = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return fold_docs(docs).withColumn("f", seek("text")).select("doc_id", "f.*")


def digests(docs: DataFrame) -> DataFrame:
    return find(docs, fit(docs))
