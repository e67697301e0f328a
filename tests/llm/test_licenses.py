import re

import pytest
from corpus import frame, rows

from crowdpulse.llm import licenses as lic

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = [(["mit", "license"], "mit"), (["apache", "license"], "apache"), (["general", "public", "license"], "gpl")]


def plain(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in NAMES for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    at = sorted(i for i, _ in places)
    return len(words), len(at), at[0] if at else None, at[-1] if at else None, ",".join(sorted({label for _, label in places}))


SPECIAL = ["MIT LICENSE mit license", "the MIT\n  License, and the General-Public_License", "mit", "license mit license", "éMIT License", "mit licenses",
           "general public license general public license", "Apache\x00License", "", None, "MIT License", "mit " * 400 + "license",
           ("word " * 30_000) + "Apache License", "İMIT Kelvin K license"]


def test_names_against_plain_search(spark):
    data = rows() + [(900 + i, t) for i, t in enumerate(SPECIAL)] + [(950, SPECIAL[0]), (950, SPECIAL[0]), (None, SPECIAL[1])]
    want = sorted([(i, *plain(t)) for i, t in data], key=str)
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    have = lic.digests(frame(spark, data)).collect()
    assert sorted([tuple(r[c] for c in names) for r in have], key=str) == want
    assert all(0.0 <= r.score <= 1.0 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in have)


@pytest.mark.parametrize("text, labels", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
     "(the \"Software\"), to deal\nin the Software without restriction, including", "mit-text"),
    ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions", "bsd"),
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Released under the MIT License.", "mit,mit-notice"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("permission is hereby granted to nobody", ""),
    ("we read about the mit license today", "mit"),
    # one word in the middle is another one: most of the weight still stands in place
    ("Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met", "bsd"),
    # a key phrase is missing
    ("Redistribution or use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ""),
])
def test_notices(spark, text, labels):
    r = lic.licenses(spark.createDataFrame([(1, f"Some words before. {text} And some behind."), (2, "nothing at all")], "doc_id long, text string")).where("doc_id = 1").first()
    assert r.labels == labels
    assert r.score == (0.0 if not labels else lic.NAMED if labels == "mit" else max(p.share for p in r.places if p.label not in ("mit", "apache", "gpl")))


def test_every_template_is_found_in_its_own_text(spark):
    docs = spark.createDataFrame([(i, f"x {t.text} y") for i, t in enumerate(lic.TEMPLATES)], "doc_id long, text string")
    found = {r.doc_id: r.labels.split(",") for r in lic.licenses(docs).collect()}
    assert all(t.label in found[i] for i, t in enumerate(lic.TEMPLATES))


def test_scan_against_every_beginning():
    """The index finds whatever a search at every place of the text finds, where enough anchors stand in place."""
    index = lic.Index(lic.TEMPLATES, 10, {})
    words = lic.words_of(" ".join(t.text for t in lic.TEMPLATES) * 2)
    found = index.scan(words)
    for t in range(len(lic.TEMPLATES)):
        least = 1.0 if lic.TEMPLATES[t].base else lic.SHARE
        want = {b for b in range(-3, len(words)) if index.share(t, words, b) >= least}
        assert {b for u, b in found if u == t} == want


def test_empty_table(spark):
    assert lic.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
