"""Small documents with every awkward case: nulls, empties, ties, repeated rows, long texts, clashing columns."""

import random

DDL = ("doc_id long, text string, lang string, source string, n_chars long, row string, gone long, h long, keep string, "
       "toxic int, doc long, id long")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows(seed=1):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    line = "the very same line that a good many documents share, letter by letter"
    for i in range(8):
        texts.append(words(rng, 20) + "\n" + line + "\n" + words(rng, 5))
    base = words(rng, 100).split()
    for i in range(6):
        w = list(base)
        w[10 * i + 3] = "changed"
        texts.append(" ".join(w))
    texts += ["", None, " \t\n", "x", "two words", texts[0], texts[0].upper(), "é ü\nß — ñ", words(rng, 5000), "a\r\nb\x0bc\x0cd"]
    out = [(i, t) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, texts[5]), (None, None), (7, "another text under a known id " + words(rng, 30))]
    return out


def frame(spark, data):
    sources = ["web", "books", None, "code", "ünï"]
    full = [(i, t, "en", sources[n % len(sources)], None if t is None else len(t), "r", 1, 2, "k", 0, 5, 6) for n, (i, t) in enumerate(data)]
    return spark.createDataFrame(full, DDL)
