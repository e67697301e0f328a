"""License scans with a positional index of rare template words.

A template is a run of words that a licence text or notice holds, with its label and the key phrases that must stand in it.
Document frequencies of all template words are counted over the whole table; a template's anchors are its rarest words by
them (highest IDF), and the index maps an anchor to its postings (template, position). A text is cut into words once. Each of
its words that is an anchor is looked up; word position less template position is where the template would have to begin, and
anchors that agree on a beginning support each other. At a beginning with support the template is read against the text word
by word: the share of its IDF weight that stands in place is the score, and it counts as found if the share reaches
``SHARE`` and all its key phrases stand there whole. Name phrases are templates that consist of one key phrase; every place
of theirs holds their anchor, so that each of their places is found and no text is searched for them otherwise.

Scanning is one pass without a shuffle; the counting before it sends at most one number a template word and task.

Defined cases: words are maximal runs of letters a-z, digits and characters beyond ASCII, A-Z lower-cased. A null or empty
text has no words: counts 0, positions null, labels empty, score 0. Copies and repeated rows get a row each. Overlapping
places count each. Template words that no text holds have the highest IDF. Null ids are kept; extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm.common import fold_docs

#: Anchors of a template, anchors that must agree on a beginning, and the share of weight that must stand in place.
ANCHORS, SUPPORT, SHARE = 6, 2, 0.8
#: The score of a text that names a licence but holds no notice of it.
NAMED = 0.5

#: ASCII characters but letters and digits become blanks, A-Z become a-z.
FOLD = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The three names that are looked for, then opening words of well-known public licences and usual notices.
BASE = (
    Template("mit", "mit license", ("mit license",), True),
    Template("apache", "apache license", ("apache license",), True),
    Template("gpl", "general public license", ("general public license",), True),
)
NOTICES = (
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
             "the software to deal in the software without restriction", ("permission is hereby granted", "without restriction")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    Template("mit-notice", "released under the mit license", ("mit license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use", "source and binary forms")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)
TEMPLATES = BASE + NOTICES


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[int, dict[bytes, int]]:
    """The number of texts, and for each template word that of texts that hold it."""
    vocabulary = frozenset(w for t in templates for w in words_of(t.text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = Counter(), 0
        for batch in batches:
            texts += batch.num_rows
            for text in batch.column(0):
                held.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.record_batch([pa.array([None, *(w.decode() for w in held)], pa.string()), pa.array([texts, *held.values()], pa.int64())], names=["word", "n"])

    counted = fold_docs(docs).select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {None if r.word is None else r.word.encode(): r.n for r in counted}
    return found.pop(None, 0), found


class Index:
    """Anchors' postings, and the templates' words, weights and key phrases."""

    def __init__(self, templates: tuple[Template, ...], texts: int, frequencies: dict[bytes, int]):
        self.templates = templates
        self.words = [words_of(t.text) for t in templates]
        self.weights = [[math.log((1 + texts) / (1 + frequencies.get(w, 0))) + 1 for w in words] for words in self.words]
        self.total = [sum(weights) for weights in self.weights]
        self.keys = [[words_of(k) for k in t.keys] for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for t, (words, weights) in enumerate(zip(self.words, self.weights, strict=True)):
            rarest = sorted(range(len(words)), key=lambda i: (-weights[i], i))
            anchors = {words[i] for i in rarest[: 1 if templates[t].base else ANCHORS]}
            places = [i for i, w in enumerate(words) if w in anchors]
            for i in places:
                self.postings[words[i]].append((t, i))
            self.needed.append(1 if templates[t].base else min(SUPPORT, len(places)))

    def share(self, t: int, words: list[bytes], begin: int) -> float:
        """The share of the template's weight that stands in place at ``begin``; 0 unless its key phrases are there."""
        own = self.words[t]
        here = words[max(begin, 0) : begin + len(own)]
        for key in self.keys[t]:
            if not any(here[i : i + len(key)] == key for i in range(len(here) - len(key) + 1)):
                return 0.0
        there = sum(w for i, (word, w) in enumerate(zip(own, self.weights[t], strict=True)) if 0 <= begin + i < len(words) and words[begin + i] == word)
        return there / self.total[t]

    def scan(self, words: list[bytes]) -> dict[tuple[int, int], float]:
        """The places (template, first word) that are found, with their shares."""
        postings = self.postings
        support: Counter = Counter()
        for i, word in enumerate(words):
            if word in postings:
                for t, at in postings[word]:
                    support[t, i - at] += 1
        found = {}
        for (t, begin), n in support.items():
            if n >= self.needed[t]:
                share = self.share(t, words, begin)
                if share >= (1.0 if self.templates[t].base else SHARE):
                    found[t, begin] = share
        return found


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "places array<struct<label:string,word:long,share:double>>")


def licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places."""
    index = Index(templates, *document_frequencies(docs, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())])
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = index.scan(words)
                base = sorted(b for t, b in found if templates[t].base)
                names = {templates[t].label for t, _ in found if templates[t].base}
                every = {templates[t].label for t, _ in found}
                score = max((NAMED if templates[t].base else share for (t, _), share in found.items()), default=0.0)
                places = [{"label": templates[t].label, "word": b, "share": share} for (t, b), share in sorted(found.items(), key=lambda x: (x[0][1], x[0][0]))]
                out.append((len(words), len(base), base[0] if base else None, base[-1] if base else None, ",".join(sorted(names)), ",".join(sorted(every)), score, places))
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return fold_docs(docs).mapInArrow(run, RESULT)


def digests(docs: DataFrame) -> DataFrame:
    return licenses(docs).drop("places")
