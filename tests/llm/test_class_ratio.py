import random

from corpus import frame, words

from crowdpulse.llm import quality, toxicity


def noisy(n=1500):
    """A tenth of the texts is marked; seven in ten of those hold the term, and one in thirty of the others."""
    rng, data, marks = random.Random(9), [], []
    for i in range(n):
        y = int(i % 10 == 0)
        w = words(rng, 30).split()
        if rng.random() < (0.7 if y else 0.03):
            w.insert(5, "zwergnase")
        data.append((i, " ".join(w)))
        marks.append((i, y))
    return data, marks


def test_toxicity_keeps_the_ratio_of_all_labelled_rows(spark):
    data, marks = noisy()
    docs, labels = frame(spark, data), spark.createDataFrame(marks, "doc_id long, toxic int")
    text = words(random.Random(10), 30)
    whole = toxicity.Scorer(toxicity.fit(docs, labels, per_class=10_000))
    sampled = toxicity.Scorer(toxicity.fit(docs, labels, per_class=100))
    assert sampled.hits(text + " zwergnase") and whole.hits(text + " zwergnase")
    assert abs(sampled.score(text)[0] - whole.score(text)[0]) < 0.05


def test_quality_keeps_the_ratio_of_all_labelled_rows(spark):
    data, marks = noisy()
    docs, labels = frame(spark, data), spark.createDataFrame([(i, 1 - y) for i, y in marks], "doc_id long, quality int")
    empty = quality.term_counts("").reshape(1, -1)
    some = quality.term_counts(words(random.Random(10), 30)).reshape(1, -1)
    for per_class in (10_000, 100):
        space = quality.fit(docs, labels, per_class=per_class)
        assert abs(space.vote(empty)[0] - 0.9) < 0.03
        assert space.vote(some, neighbours=200)[0] > 0.8      # the marks say nothing about the characters
