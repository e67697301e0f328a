import os

import numpy as np
from corpus import frame

from crowdpulse.llm import pii, quality


def test_personal_data_is_learned_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(pii, "learn", lambda texts: (os.getpid(), texts))
    where, texts = pii.fit(frame(spark, [(1, "call 555"), (2, "a@b"), (2, "a@b"), (3, "none"), (None, "77")]))
    assert where != os.getpid() and texts == ["a@b", "call 555"]
    assert pii.fit(frame(spark, [(3, "none")])) is None


def test_quality_terms_are_counted_in_tasks(spark, monkeypatch):
    driver, terms = os.getpid(), quality.TERMS

    def count(text):
        assert os.getpid() != driver
        return np.full(terms, len(text), dtype=np.float32)

    monkeypatch.setattr(quality, "term_counts", count)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    space = quality.fit(frame(spark, [(i, "x" * (3 + i)) for i in range(20)] + [(0, "xxx")]), labels)
    assert 10 < len(space.labels) < 20 and space.vectors.shape == (len(space.labels), 48)
