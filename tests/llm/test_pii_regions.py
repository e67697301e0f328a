import random

import numpy as np

from crowdpulse.llm import pii


def field():
    """A learned stand-in: ten digits in a row are a phone, whatever stands around them."""
    weights = np.zeros((len(pii.KINDS), pii.FEATURES))
    weights[:, 0] = -9
    weights[pii.KINDS.index("phone"), 4] = 12       # 9 to 12 digits
    weights[pii.KINDS.index("phone"), 21] = 3       # in one group
    weights[pii.KINDS.index("phone"), 23:25] = -8   # not cut out of a word
    return pii.Field(weights, 0.0)


def phones(text):
    base, added = pii.all_spans(text, field())
    assert base == []
    return [text[a:z] for kind, a, z in added if kind == "phone"]


def numbers(rng, n):
    return [str(rng.randint(2 * 10**9, 9 * 10**9)) for _ in range(n)]


def test_a_line_of_a_thousand_numbers_is_read_whole():
    want = numbers(random.Random(1), 1000)
    assert phones(" ".join(want)) == want
    assert phones("call one of " + ", ".join(want) + " and then some words") == want


def test_a_long_token_without_blanks_is_read_whole():
    want = numbers(random.Random(2), 50)
    text = "{" + ",".join(f'"{"key" * 26}":"{x}"' for x in want) + "}"
    assert len(text) > 4500 and " " not in text and phones(text) == want
    assert phones("x" * 5000 + ":" + want[0] + "," + "y" * 5000) == want[:1]


def test_every_digit_and_at_sign_is_in_one_region():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("ab1@.- \t\n\xa0") for _ in range(rng.randint(0, 80)))
        covered = [i for a, z in pii.regions(text) for i in range(a, z)]
        assert len(covered) == len(set(covered))
        assert {i for i, c in enumerate(text) if c in "1@"} <= set(covered)


def best_score(text, units, f):
    """The best segmentation's score, all segments at once."""
    r = pii.read_region(text, units, f.longest)
    scores = r.features @ f.weights.T
    best = np.full((len(units) + 1, 2), -np.inf)
    best[0, 0] = 0
    for j in range(1, len(units) + 1):
        best[j, 0] = best[j - 1].max()
        for k, (i, end) in enumerate(r.segments):
            if end == j:
                best[j, 1] = max(best[j, 1], scores[k].max() + max(best[i, 0], best[i, 1] + f.adjacent))
    return best[-1].max()


def test_blocks_do_not_change_the_best_segmentation():
    rng, noise = random.Random(4), np.random.default_rng(4)
    for _ in range(60):
        f = pii.Field(noise.normal(size=(len(pii.KINDS), pii.FEATURES)), float(noise.normal()), longest=8)
        text = "".join(rng.choice("ab12345678@.+- ") for _ in range(60)).strip() or "1"
        units = [m.span() for m in pii.UNIT.finditer(text)]
        found = f.decode(text, units, block=3)
        assert found == f.decode(text, units, block=1000)
        place = {(r[0], r[1]): k for k, r in enumerate(pii.read_region(text, units, 8).segments)}
        starts, ends = {u[0]: i for i, u in enumerate(units)}, {u[1]: i + 1 for i, u in enumerate(units)}
        rows = pii.read_region(text, units, 8).features @ f.weights.T
        total, free = 0.0, None
        for kind, a, z in found:
            total += rows[place[starts[a], ends[z]], pii.KINDS.index(kind)] + f.adjacent * (free == starts[a])
            free = ends[z]
        assert np.isclose(total, best_score(text, units, f))
