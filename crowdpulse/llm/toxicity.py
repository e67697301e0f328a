"""Toxicity scores from a learned lexicon, matched through misspellings, read in context.

The lexicon is learned from labelled texts: whole words and word stems that toxic texts share and clean ones lack,
chosen so that each new term explains texts that the earlier ones leave open (a term that only a group of near copies
shares explains too little). The terms form a trie. The automaton of all strings within a term's edit distance
(Levenshtein) is intersected with the trie and made deterministic state by state as words are read, so a word costs
one table step per character and most words end in the dead state after a few.

Words are what stands between blanks, less the marks at its edges, and also its parts between characters that are neither
letter, mark nor digit ("you,idiot", "<p>idiot</p>"); of a word and its parts the reading with more evidence counts.
Words have no length limit. In an unbroken run of letters a stem is found where the run begins, not inside it.

Each hit is scored in a window of words around it: quotation marks, and words that speak about a word, mark a
quotation and shrink the hit; address in the second person strengthens it. Quotations of several words are found by
pairing opening and closing marks within a line: what is said about them stands around the whole quotation (its window
begins at the marks, and the words of reporting count too), and address inside it is the quoted speaker's, so it does
not strengthen. A mark without its partner on the line quotes nothing. Each hit counts the logarithm of how much
more often toxic than clean texts use its term; a logistic curve over the sum and the text's length gives the score.

Defined cases: null and empty texts have no hits; a null ``doc_id`` is in no fold (not held out) and
never trained on; repeated rows score alike. Whole texts are read, whatever their length.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import doc_key, fold_docs

# Words that speak about a word, and second-person address (en, de, fr, es).
ABOUT = frozenset("word words term called quote quoted said says wrote means meaning definition slur insult "
                  "wort begriff sagte zitat heißt mot terme disait citation signifie palabra término dijo cita significa".split())
ADDRESS = frozenset("you your you're du dich dein ihr tu toi vous votre tú te usted".split())
# Words that report what somebody else said, read around quotations of several words (en, de, fr, es).
REPORT = frozenset("reported report reports told tells heard shouted yelled screamed cited according court judge witness testified "
                   "berichtete laut schrie rief gericht zeuge rapporté selon tribunal juge témoin crié "
                   "según informó tribunal juez testigo gritó".split())
OPENING, CLOSING = "\"'“„«‘([", "\"'”“»’)]"
# Marks that enclose several words, and what closes each. Apostrophes stay out: they end words.
PAIRS = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’", "”": "”"}
BREAK = re.compile(r"[\W_]")
EDGES = "\"'“”„«»‘’()[]{}<>.,;:!?*%&$#|_-+=~/\\"


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool          # a stem matches every word that begins with it
    edits: int          # allowed edit distance
    weight: float       # log of its rate in toxic over its rate in clean texts

    @property
    def name(self) -> str:
        return self.text + ("*" if self.stem else "")


class FuzzyTrie:
    """The terms' trie intersected with their Levenshtein automata, determinised on demand.

    A state is a set of (trie node, edits spent) pairs. ``state_limit`` bounds the table of a long-lived worker: when
    it is full the table starts afresh, with the same answers.
    """

    def __init__(self, terms: Iterable[Term], state_limit: int = 200_000):
        self.terms = list(terms)
        self.limit = state_limit
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        for i, t in enumerate(self.terms):
            node = 0
            for ch in t.text:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                node = self.children[node][ch]
            self.ends[node].append(i)
        self.room = [0] * len(self.children)        # most edits any term below the node allows
        for node in range(len(self.children) - 1, -1, -1):
            self.room[node] = max([0, *(self.terms[i].edits for i in self.ends[node]),
                                   *(self.room[c] for c in self.children[node].values())])
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.stem_hit: list[tuple[int, int] | None] = []
        self.word_hit: list[tuple[int, int] | None] = []
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, spent: dict[int, int]) -> int:
        """Close over skipped term letters and number the state."""
        todo = list(spent)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                cost = spent[node] + 1
                if cost <= self.room[child] and cost < spent.get(child, 99):
                    spent[child] = cost
                    todo.append(child)
        key = frozenset(spent.items())
        if key in self.ids:
            return self.ids[key]
        self.ids[key] = len(self.sets)
        self.sets.append(key)
        self.next.append({})
        best: dict[bool, tuple[int, int] | None] = {True: None, False: None}
        for node, cost in spent.items():
            for i in self.ends[node]:
                if cost <= self.terms[i].edits:
                    stem = self.terms[i].stem
                    best[stem] = min(x for x in (best[stem], (cost, i)) if x is not None)
        self.stem_hit.append(best[True])
        self.word_hit.append(best[False])
        return self.ids[key]

    def _step(self, state: int, ch: str) -> int:
        spent: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.room[node] and cost < spent.get(node, 99):
                spent[node] = cost

        for node, cost in self.sets[state]:
            reach(node, cost + 1)                                   # a letter too many
            for c, child in self.children[node].items():
                reach(child, cost + (c != ch))                      # the letter, or another one
        self.next[state][ch] = to = self._state(spent)
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, index) of the nearest term, or None."""
        if len(self.sets) > self.limit:
            self._reset()
        state, stem, dead = self.start, None, self.dead
        for ch in word:
            to = self.next[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if state == dead:
                return stem
            if self.stem_hit[state] is not None and (stem is None or self.stem_hit[state] < stem):
                stem = self.stem_hit[state]
        whole = self.word_hit[state]
        return min((x for x in (stem, whole) if x is not None), default=None)


def parts_of(word: str) -> list[str]:
    """What stands between characters that are neither letter, mark nor digit; nothing if that is the whole word."""
    if not BREAK.search(word):
        return []
    parts = "".join(c if c.isalnum() or unicodedata.category(c)[0] == "M" else " " for c in word).split()
    return [] if parts == [word] else parts


def tokens_of(text: str) -> set[str]:
    words = {x.strip(EDGES) for x in set(text.lower().split())}
    words.update(p for w in list(words) for p in parts_of(w))
    return words - {""}


@dataclass
class Model:
    """A lexicon and the logistic curve over (1, evidence, its square root, log of the word count)."""
    terms: list[Term]
    curve: list[float]


@dataclass
class Scorer:
    model: Model
    window: int = 6
    trie: FuzzyTrie = field(init=False)

    def __post_init__(self):
        self.terms = self.model.terms
        self.trie = FuzzyTrie(self.terms)

    def hits(self, text: str) -> list[tuple[int, str, int, float]]:
        """(word position, term, edits, evidence) of each hit, in order."""
        found = {w: m for w in tokens_of(text) if (m := self.trie.match(w)) is not None}
        if not found:
            return []
        raw = text.lower().split()
        spans = quotations(text.lower())
        starts = [a for a, _ in spans]
        out = []
        for at, token in enumerate(raw):
            word = token.strip(EDGES)
            parts = parts_of(word)
            whole, inner = found.get(word), [(i, m) for i, p in enumerate(parts) if (m := found.get(p)) is not None]
            if whole is None and not inner:
                continue
            near = [x.strip(EDGES) for x in raw[max(0, at - self.window):at] + raw[at + 1:at + 1 + self.window]]
            k = bisect_right(starts, at) - 1
            around = None
            if k >= 0 and at <= spans[k][1]:
                a, z = spans[k]
                around = [x.strip(EDGES) for x in raw[max(0, a - self.window):a] + raw[z + 1:z + 1 + self.window]]
            readings = [[self._hit(at, whole, token, near, around)]] if whole is not None else []
            if inner:
                near += [p for x in near for p in parts_of(x)]
                readings.append([self._hit(at, m, token, near + parts[max(0, i - self.window):i] + parts[i + 1:i + 1 + self.window], around)
                                 for i, m in inner])
            out += max(readings, key=lambda hits: sum(h[3] for h in hits))
        return out

    def _hit(self, at: int, m: tuple[int, int], token: str, near: list[str], around: list[str] | None) -> tuple[int, str, int, float]:
        term = self.terms[m[1]]
        return at, term.name, m[0], term.weight * 0.9 ** m[0] * _context(token, near, around)

    def evidence(self, text: str) -> tuple[list[float], list[str]]:
        hits = self.hits(text)
        e = sum(h[3] for h in hits)
        return [1.0, e, math.sqrt(e), math.log1p(len(text.split()))], sorted({h[1] for h in hits})

    def score(self, text: str) -> tuple[float, list[str]]:
        x, names = self.evidence(text)
        z = sum(a * b for a, b in zip(x, self.model.curve, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), names


def quotations(text: str) -> list[tuple[int, int]]:
    """(first, last) word of each quotation of several words, in order, disjoint. Marks pair within a line: a mark at a
    word's end closes what the latest fitting mark at a word's start opened; a quotation takes in those inside it."""
    out: list[tuple[int, int]] = []
    at = 0
    for line in text.splitlines():
        words = line.split()
        opened: dict[str, int] = {}      # closing mark -> the word that opened what it closes
        for i, w in enumerate(words):
            core = w.strip(EDGES)
            if w[0] in EDGES:
                for c in w[:len(w) - len(w.lstrip(EDGES))]:
                    for end in PAIRS.get(c, ""):
                        if core or end not in opened:       # a mark alone closes, if it can
                            opened[end] = i
            if opened and w[-1] in EDGES:
                for c in w[len(w.rstrip(EDGES)):]:
                    begin = opened.get(c, i)
                    if begin < i:
                        opened = {end: b for end, b in opened.items() if b < begin}
                        while out and out[-1][0] >= at + begin:
                            out.pop()
                        out.append((at + begin, at + i))
                    elif core:
                        opened.pop(c, None)                 # one word in marks
        at += len(words)
    return out


def _context(token: str, near: list[str], around: list[str] | None = None) -> float:
    """How much a hit counts, by the words around it; ``around`` are those beside the quotation of several words it is in."""
    if around is not None:
        return 0.2 if any(w in ABOUT or w in REPORT for w in around) else 0.7
    quoted = token[0] in OPENING and token.rstrip(".,;:!?")[-1:] in CLOSING
    about = any(w in ABOUT for w in near)
    if quoted and about:
        return 0.2
    if quoted or about:
        return 0.7
    return 1.2 if any(w in ADDRESS for w in near) else 1.0


def learn(toxic: list[str], clean: list[str], stem_lengths=(3, 4, 5, 6, 7, 8), least: float | None = None, most_terms: int = 400,
          ratio: float = 12.0, weights: tuple[float, float] = (1.0, 1.0)) -> Model:
    """The lexicon and curve that tell the toxic from the clean texts.

    A candidate is a word or a stem that at least three toxic texts hold, and ``ratio`` times as large a share of them
    as of the clean ones. Terms are taken greedily by how many toxic texts they explain, less the clean ones they would
    accuse; a text counts half for each term that it already has. Below ``least`` such texts a term may be an accident
    of a few copies, and the search ends (2.5 texts unless given, and one in 150 of the toxic ones). ``weights`` say how
    many labelled texts each toxic and each clean one stands for.
    """
    least = max(2.5, len(toxic) / 150) if least is None else least
    toxic, clean = list(dict.fromkeys(toxic)), list(dict.fromkeys(clean))
    # texts are read again where their forms are needed: only counts and the few candidates are held
    held: Counter[str] = Counter()
    for t in toxic:
        held.update(_forms(tokens_of(t), stem_lengths))
    held = Counter({f: n for f, n in held.items() if n >= 3})
    against: Counter[str] = Counter()
    for t in clean:
        against.update(f for f in _forms(tokens_of(t), stem_lengths) if f in held)
    rate = len(clean) / max(1, len(toxic))
    where = {f: [] for f in held if held[f] * rate >= ratio * (against[f] + 0.1)}
    own = [[f for f in _forms(tokens_of(t), stem_lengths) if f in where] for t in toxic]
    for i, fs in enumerate(own):
        for f in fs:
            where[f].append(i)
    share = [1.0] * len(toxic)
    # a clean text weighs ten times a toxic one: else a short stem of common words would swallow the precise terms below it
    gain = {f: len(at) - 10 * against[f] / max(rate, 1e-9) for f, at in where.items()}
    chosen: list[str] = []
    while gain and len(chosen) < most_terms:
        best = max(gain, key=lambda f: (round(gain[f] * (1 + 0.03 * min(len(f), 8)), 6), not f.endswith("*"), len(f), f))
        if gain.pop(best) < least:
            break
        if any(_says_again(best, c, held) for c in chosen):
            continue
        chosen.append(best)
        for i in where[best]:
            share[i] /= 2
            for f in own[i]:
                if f in gain:
                    gain[f] -= share[i]
    terms = _weighed(_with_edits(chosen, toxic, clean, weights), toxic, clean)
    return Model(terms, _curve(terms, toxic, clean, weights))


def _says_again(f: str, chosen: str, held: Counter) -> bool:
    """``f`` lies under the chosen stem, or is a stem of the chosen term that hardly any other text holds."""
    if chosen.endswith("*") and f.startswith(chosen[:-1]):
        return True
    return f.endswith("*") and chosen.startswith(f[:-1]) and held[f] <= 1.3 * held[chosen]


def _forms(words: set[str], stem_lengths) -> set[str]:
    return words | {w[:n] + "*" for w in words for n in stem_lengths if len(w) > n}


def _with_edits(chosen: list[str], toxic: list[str], clean: list[str], weights: tuple[float, float]) -> list[Term]:
    """Whole words of five letters and more may be misspelled; where clean texts then hit too, one edit less."""
    terms = [Term(f.rstrip("*"), f.endswith("*"), 0 if f.endswith("*") or len(f) < 5 else 1 if len(f) < 9 else 2, 1.0) for f in chosen]
    for _ in range(2):
        trie, wrong, right = FuzzyTrie(terms), Counter(), Counter()
        for texts, into in ((clean, wrong), (toxic, right)):
            for t in texts:
                into.update({m[1] for w in tokens_of(t) if (m := trie.match(w)) is not None and m[0] > 0})
        terms = [t if t.edits == 0 or wrong[i] * weights[1] <= 0.02 * right[i] * weights[0] else Term(t.text, t.stem, t.edits - 1, 1.0)
                 for i, t in enumerate(terms)]
    return terms


def _weighed(terms: list[Term], toxic: list[str], clean: list[str]) -> list[Term]:
    """Each term's weight: the log ratio of its uses per word."""
    scorer = Scorer(Model(terms, []))
    uses, size = {}, {}
    for y, texts in ((1, toxic), (0, clean)):
        uses[y] = Counter(h[1] for t in texts for h in scorer.hits(t))
        size[y] = sum(len(t.split()) for t in texts) + 1
    rate = {t.name: ((uses[1][t.name] + 0.5) / size[1]) / ((uses[0][t.name] + 0.5) / size[0]) for t in terms}
    return [Term(t.text, t.stem, t.edits, max(0.1, min(8.0, math.log(rate[t.name])))) for t in terms]


def _curve(terms: list[Term], toxic: list[str], clean: list[str], weights: tuple[float, float], steps: int = 60,
           ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton steps; both classes weigh as all labelled rows have them (on average 1)."""
    scorer = Scorer(Model(terms, []))
    x = np.array([scorer.evidence(t)[0] for t in [*toxic, *clean]] or [[1.0, 0, 0, 0]])
    y = np.array([1.0] * len(toxic) + [0.0] * len(clean) or [0.0])
    each = np.where(y == 1, *weights)
    each /= each.mean()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (each * (y - p)) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def remainder(modulus: int, c: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(c).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """doc_id, text, y, weight of at most ``per_class`` training rows of either class, chosen by a hash of the id. A row's
    weight is how many training rows of its class it stands for, so that the classes keep their ratio at any table size.

    The bound makes the chosen ids safe to broadcast and the texts safe to bring together in one place.
    """
    marked = labels.select(doc_key().alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull())
    marked = marked.where(train).groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id", F.lit(17))
    picked = marked.where("y = 0").orderBy(order, "doc_id").limit(per_class).unionByName(
        marked.where("y = 1").orderBy(order, "doc_id").limit(per_class))
    counts = marked.where("y in (0, 1)").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    picked = picked.join(F.broadcast(counts), "y").withColumn("weight", F.col("n") / F.least("n", F.lit(per_class)))
    return fold_docs(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y", "weight")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, modulus: int = 5, held: int = 0) -> Model:
    """The model, learned from labelled rows outside the held-out fold. The bounded sample meets in one task, and only
    the model comes to the driver."""
    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(r for b in batches for r in zip(b["doc_id"], b["y"], b["text"], b["weight"], strict=True))
        if rows:
            weight = {y: w for _, y, _, w in rows}
            model = learn([t for _, y, t, _ in rows if y == 1], [t for _, y, t, _ in rows if y == 0],
                          weights=(weight.get(1, 1.0), weight.get(0, 1.0)))
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    sample = labelled_sample(docs, labels, "toxic", remainder(modulus) != held, per_class)
    learned = sample.repartition(1).mapInPandas(train, "model binary").first()
    return pickle.loads(learned["model"]) if learned else learn([], [])


def judge(model: Model, docs: DataFrame):
    """Text to (score, terms), as a column function with the model broadcast (its size is bounded by most_terms)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score double, terms array<string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            done = [scorer.score(t) for t in texts]
            yield pd.DataFrame({"score": [d[0] for d in done], "terms": [d[1] for d in done]})
    return run


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return docs.where(judge(model, docs)(F.coalesce(F.col("text").cast("string"), F.lit("")))["score"] < threshold)


def scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, terms."""
    model = fit(docs, labels, modulus=modulus, held=held)
    scored = fold_docs(docs).select("doc_id", judge(model, docs)("text").alias("s"))
    return scored.select("doc_id", F.coalesce(remainder(modulus) == held, F.lit(False)).alias("held_out"),
                         F.col("s.score").alias("score"), (F.col("s.score") >= threshold).cast("int").alias("predicted"),
                         F.col("s.terms").alias("terms"))
