"""Recall and precision of the spans that the field adds to the base ones: other ways to write the same data, and
numbers that are nobody's, in places drawn at random. Cards with slashes or underscores, phones with a slash and a blank,
and numbers with a word or letters before them are not among the forms that the field learns from; the other forms are."""

import random

import pytest

from crowdpulse.llm import pii


def digits(rng, n):
    return str(rng.randint(1, 9)) + "".join(rng.choice("0123456789") for _ in range(n - 1))


def card(rng):
    body = rng.choice("45") + digits(rng, 14)
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def no_card(rng):
    body = digits(rng, 15)
    return next(body + c for c in "0123456789" if not pii.luhn(body + c))


def prose(rng, n):
    return " ".join("".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def training(rng, n=300):
    """Texts as the base patterns read them: one phone, email, address and card each, and a number that is no card."""
    made = []
    for _ in range(n):
        quad = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        things = [f"+1 ({digits(rng, 3)}) {digits(rng, 3)}-{digits(rng, 4)}", f"{prose(rng, 1)}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
                  quad, card(rng), no_card(rng), f"{rng.randint(1, 9)}.{rng.randint(1, 9)}."]
        rng.shuffle(things)
        made.append(" ".join(f"{prose(rng, 5)} {t}" for t in things) + " " + prose(rng, 4) + ".")
    return made


def personal(rng):
    n, quads = (lambda k: digits(rng, k)), (lambda c: [c[i:i + 4] for i in range(0, 16, 4)])
    who, host = rng.choice(["anna", "j.doe", "kim_99", "info"]), rng.choice(["example.com", "mail.host.org", "web-site.co.uk"])
    return [("phone", f"({n(3)}) {n(3)}-{n(4)}"), ("phone", f"{n(3)}-{n(3)}-{n(4)}"), ("phone", f"00{n(2)} {n(3)} {n(3)} {n(4)}"),
            ("phone", f"{n(3)}/{n(3)} {n(4)}"), ("phone", f"{n(3)} {n(3)} {n(4)}"), ("card", ".".join(quads(card(rng)))),
            ("card", "/".join(quads(card(rng)))), ("card", "_".join(quads(card(rng)))), ("email", f"{who} @ {host}"),
            ("email", f"{who}@ {host}"), ("email", f"{who} @{host}"), ("phone", f"{n(3)}.{n(3)}.{n(4)}")]


def nobodys(rng):
    n = lambda k: digits(rng, k)
    y, m, d = rng.randint(1990, 2025), rng.randint(1, 12), rng.randint(1, 28)
    return [f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{y}-{m:02d}-{d:02d} {rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}",
            f"order {n(8)}", f"order no. {n(10)}", f"ISBN 978-3-{n(2)}-{n(6)}-{n(1)}", f"INV-{y}{m:02d}{d:02d}-{n(4)}", f"{n(1)},{n(3)},{n(3)},{n(3)}",
            f"3.{n(11)}", n(7), f"{n(8)}-{n(4)}", no_card(rng), f"id {n(9)}", f"v{n(1)}.{n(2)}.{n(4)}", f"{y}/{m:02d}/{d:02d} {rng.randint(10, 23)}h",
            f"{n(4)} - {n(4)}", f"pages {n(3)}-{n(3)}", f"{n(1)}.{n(1)}. {n(1)}.{n(1)}."]


@pytest.fixture(scope="module")
def field():
    return pii.learn(training(random.Random(11)))


def test_recall_of_planted_forms(field):
    rng, found, planted = random.Random(12), 0, 0
    for _ in range(40):
        for kind, s in personal(rng):
            before = prose(rng, 6) + " "
            base, added = pii.all_spans(f"{before}{s} {prose(rng, 6)}.", field)
            planted += 1
            found += any(k == kind and a <= len(before) + 1 and z == len(before) + len(s) for k, a, z in base + added)
    assert found >= 0.9 * planted


def test_precision_on_numbers_that_are_nobodys(field):
    rng, wrong, seen = random.Random(13), 0, 0
    for _ in range(40):
        for s in nobodys(rng):
            base, added = pii.all_spans(f"{prose(rng, 6)} {s} {prose(rng, 6)}.", field)
            seen += 1
            wrong += bool(added)
    assert wrong <= 0.02 * seen


def test_words_around_a_spaced_at_sign_are_in_its_region():
    for text, want in (("mail anna @ web.org now", "anna @ web.org"), ("anna@ web.org", "anna@ web.org"), ("so anna @web.org", "anna @web.org"),
                       ("one  @web.org", "@web.org"), ("@ web", "@ web"), ("a\n@b", "@b"), (" @", "@"), ("@", "@")):
        parts = [text[units[0][0]:units[-1][1]] for a, z in pii.regions(text) if (units := pii.units_of(text, a, z))]
        assert parts == [want], text
