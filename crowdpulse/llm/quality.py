"""Quality scores by a vote of the nearest labelled texts in a latent-semantic space.

A text's terms are the trigrams of its character classes (space, newline, lower, upper, digit, letter beyond ASCII,
sentence mark, bar, exclamation, other mark), binned shares of repeated words, and its words, hashed to a fixed number
of slots; its term weights are sublinear counts
times inverse document frequency. A truncated singular value decomposition of a bounded sample of labelled texts gives
the latent axes. The sample's vectors (``per_class`` rows of each label at most) are broadcast; every document is
compared to all of them in blocked matrix products, exact, and its ``neighbours`` nearest vote with their cosines'
power as weight, times the number of labelled rows that each stands for (the sample does not keep the labels' ratio).

Defined cases: a null or empty text has a zero vector, no neighbour is nearer than another, and the mean label of all
training rows is its score; a null ``doc_id`` is in no fold; repeated rows score alike; without any label the score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import fold_docs
from crowdpulse.llm.toxicity import labelled_sample, remainder

KINDS, BINS, SLOTS = 10, 10, 512
WORDS = KINDS ** 3 + 4 * BINS      # the first slot of the words
TERMS = WORDS + SLOTS
CONTINUED = bytes(range(0x80, 0xC0))


def _class_table() -> bytes:
    kinds = np.full(256, 9, dtype=np.uint8)
    kinds[[9, 11, 12, 13, 32]] = 0
    kinds[10] = 1
    kinds[ord("a"):ord("z") + 1] = 2
    kinds[ord("A"):ord("Z") + 1] = 3
    kinds[ord("0"):ord("9") + 1] = 4
    kinds[0xC0:] = 5
    kinds[[ord(c) for c in ".,;:"]] = 6
    kinds[ord("|")] = 7
    kinds[[ord(c) for c in "!?"]] = 8
    return kinds.tobytes()


CLASSES = _class_table()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of class trigrams per thousand characters, one marked bin for each share, and hashed words per hundred."""
    out = np.zeros(TERMS, dtype=np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    kinds = np.frombuffer(raw.translate(CLASSES, CONTINUED), dtype=np.uint8).astype(np.int32)
    if len(kinds) < 3:
        return out
    out[:KINDS ** 3] = np.bincount(kinds[:-2] * 100 + kinds[1:-1] * 10 + kinds[2:], minlength=KINDS ** 3) * (1000 / len(kinds))
    words = raw.lower().split()
    n = max(1, len(words))
    shares = (sum(map(eq, words, words[1:])) / n, min(1.0, len(set(words)) / n ** 0.8),
              min(0.99, len(kinds) / n / 16), min(0.99, 10 * raw.count(b"\n") / len(raw)))
    for i, share in enumerate(shares):
        out[KINDS ** 3 + i * BINS + min(BINS - 1, int(share * BINS))] = 30
    slots = np.fromiter(map(crc32, words), dtype=np.int64, count=len(words)) % SLOTS
    out[WORDS:] = np.bincount(slots, minlength=SLOTS) * (100 / n)
    return out


@dataclass
class Space:
    idf: np.ndarray         # per term
    axes: np.ndarray        # terms x dimensions
    vectors: np.ndarray     # labelled texts x dimensions, of unit length
    labels: np.ndarray
    weights: np.ndarray     # training rows that each labelled text stands for

    def embed(self, counts: np.ndarray) -> np.ndarray:
        v = (np.log1p(counts) * self.idf) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def vote(self, counts: np.ndarray, neighbours: int = 15, power: int = 8) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = self.embed(counts) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        at = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, at, axis=1), 0) ** power
        near = w.sum(axis=1)
        w = w * self.weights[at]
        total = w.sum(axis=1)
        score = (w * self.labels[at]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where(near > 1e-9, np.clip(score, 0, 1), np.average(self.labels, weights=self.weights))


def fit_space(counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, dimensions: int = 48) -> Space:
    """Latent axes: the leading right singular vectors of the weighted term matrix."""
    n = len(labels)
    idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1 if n else np.ones(TERMS, dtype=np.float32)
    x = np.log1p(counts) * idf
    _, vecs = np.linalg.eigh(x.T @ x)
    space = Space(idf, np.ascontiguousarray(vecs[:, ::-1][:, :dimensions]).astype(np.float32), np.zeros((0, dimensions)),
                  np.asarray(labels, dtype=np.float64), np.asarray(weights, dtype=np.float64))
    space.vectors = space.embed(counts).astype(np.float32)
    return space


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, modulus: int = 4, held: int = 2) -> Space:
    """The space of at most ``per_class`` labelled rows of each label, none of the held-out fold. Terms are counted in the
    tasks: the driver gets their counts, not the texts."""
    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([term_counts(t).tobytes() for t in texts], dtype=object)

    sample = labelled_sample(docs, labels, "quality", remainder(modulus) != held, per_class)
    sample = sample.select("doc_id", "y", "weight", F.sha2("text", 256).alias("digest"), counted("text").alias("counts"))
    sample = sample.toPandas().sort_values("doc_id").drop_duplicates("digest")
    counts = np.frombuffer(b"".join(sample["counts"]), dtype=np.float32).reshape(-1, TERMS)
    return fit_space(counts, sample["y"].to_numpy(), sample["weight"].to_numpy())


def score_documents(docs: DataFrame, space: Space, threshold: float = 0.7, block: int = 256) -> DataFrame:
    """doc_id, quality_score, quality of every document; ``block`` texts are compared at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            scores = [np.zeros(0)]
            for i in range(0, len(texts), block):
                scores.append(shared.value.vote(np.array([term_counts(t) for t in texts.iloc[i:i + block]])))
            yield pd.Series(np.concatenate(scores))

    scored = fold_docs(docs).select("doc_id", judge("text").alias("quality_score"))
    return scored.withColumn("quality", (F.col("quality_score") >= threshold).cast("int"))


def scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_documents(docs, fit(docs, labels, modulus=modulus, held=held))
    return scored.select("doc_id", F.coalesce(remainder(modulus) == held, F.lit(False)).alias("held_out"),
                         F.col("quality_score").alias("score"), F.col("quality").alias("predicted"))
