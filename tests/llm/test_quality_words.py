import random

import numpy as np
from corpus import frame

from crowdpulse.llm import quality


def test_texts_that_differ_only_in_words_have_different_vectors(spark):
    rng, data, marks = random.Random(4), [], []
    good, bad = ["house", "river", "green", "stone"], ["spamx", "buyit", "cheap", "click"]
    for i in range(300):
        data.append((i, " ".join(rng.choice(bad if i % 3 == 0 else good) for _ in range(40))))
        marks.append((i, int(i % 3 != 0)))
    space = quality.fit(frame(spark, data), spark.createDataFrame(marks, "doc_id long, quality int"))
    counts = np.array([quality.term_counts(" ".join(w * 10)) for w in (good, bad)])
    # five letters and a blank throughout: the character classes and shares are the same
    assert (counts[0][:1000] == counts[1][:1000]).all()
    scores = space.vote(counts)
    assert scores[0] > 0.9 and scores[1] < 0.1
