"""Line deduplication over a whole corpus, decisions as compressed keep bitmaps.

Every line that is long enough becomes a (128-bit hash, document) pair. The pairs are range-partitioned by hash and
document and sorted inside each partition, so one pass streams each line's holders, the newest document first. A
frequent line stays whole in its first holder and is dropped from the others. Because the document is part of the
range key, a line held by a third of the corpus spreads over many partitions; only the runs that touch a partition's
edge (two hashes a partition at most) are decided by a second, map-side combined aggregate.

Results travel as one zlib-compressed bitmap per touched document, never as text.

Defined cases: a null or empty text is one empty line; null ``doc_id`` sorts as the oldest document; rows that repeat
id and text get the same decision; a document that holds a line twice keeps or loses both.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import BLANKS, fold_docs, packed, stash

OLDEST = -(1 << 63)


def line_keys(text: str) -> list[bytes]:
    """Per line of the text: stripped of blanks at both ends, A-Z lower-cased."""
    return [x.strip(BLANKS) for x in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "surrogatepass"))


def _identified(docs: DataFrame) -> DataFrame:
    """doc (null id: the oldest), rid (hash of the text) and text: rows that agree in both are one document."""
    d = fold_docs(docs)
    return d.select(F.coalesce("doc_id", F.lit(OLDEST)).alias("doc"), F.xxhash64("text").alias("rid"), "doc_id", "text")


def _occurrences(min_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, rid, text in zip(b["doc"], b["rid"], b["text"], strict=True):
                held: dict[bytes, list[int]] = {}
                keys = line_keys(text)
                for pos, key in enumerate(keys):
                    if len(key) >= min_chars and code_points(key) >= min_chars:
                        held.setdefault(xxhash.xxh3_128_digest(key), []).append(pos)
                out += [(h, doc, rid, len(keys), at) for h, at in held.items()]
            yield pd.DataFrame(out, columns=["h", "doc", "rid", "n_lines", "at"])
    return run


ROW = ["h", "doc", "rid", "n_lines", "at"]
ROW_DDL = "h binary, doc long, rid long, n_lines int, at array<int>"


def _stream(min_docs: int):
    """One sorted partition: the rows that lose their lines, and as ``edge`` the undecided rows of its outer runs.

    A run that begins inside the partition knows its newest holder, so everything after its first ``min_docs``
    holders is dropped at once; only the rows of those holders wait for the run's end.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = current = newest = last_doc = None
        holders, waiting = 0, []
        for b in batches:
            out = []
            for row in zip(*(b[c] for c in ROW), strict=True):
                h, doc = row[0], row[1]
                if h != current:
                    if holders >= min_docs:
                        out += [(False, *w) for w in waiting if w[1] != newest]
                    first = h if first is None else first
                    current, newest, last_doc, holders, waiting = h, doc, None, 0, []
                if h == first:
                    out.append((True, *row))
                    continue
                holders, last_doc = holders + (doc != last_doc), doc
                if holders <= min_docs:
                    waiting.append(row)
                else:
                    out.append((False, *row))
            if out:
                yield pd.DataFrame(out, columns=["edge", *ROW])
        if waiting:
            yield pd.DataFrame([(True, *w) for w in waiting], columns=["edge", *ROW])
    return run


def _bitmaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        maps = []
        for n, at in zip(b["n_lines"], b["at"], strict=True):
            keep = np.ones(n, dtype=bool)
            keep[np.asarray(at, dtype=np.int64)] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pd.DataFrame({"doc": b["doc"], "rid": b["rid"], "keep": maps})


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, rid, keep) for each document that loses lines; ``keep`` is a zlib-compressed bit per line, 1: it stays."""
    found = stash(_identified(docs).select("doc", "rid", "text").mapInPandas(_occurrences(min_chars), ROW_DDL), "lines")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (found.repartitionByRange(parts, "h", F.desc("doc"))
               .sortWithinPartitions("h", F.desc("doc"), "rid", "at"))
    seen = stash(ordered.mapInPandas(_stream(min_docs), "edge boolean, " + ROW_DDL), "line-runs")
    edge = seen.where("edge")
    # two hashes a partition at most, however many documents hold them
    runs = (edge.groupBy("h", "doc").agg(F.lit(1).alias("x")).groupBy("h")
            .agg(F.count("x").alias("holders"), F.max("doc").alias("newest")).where(F.col("holders") >= min_docs))
    late = edge.join(F.broadcast(runs), "h").where(F.col("doc") != F.col("newest"))
    drops = seen.where(~F.col("edge")).select("doc", "rid", "n_lines", "at").unionByName(
        late.select("doc", "rid", "n_lines", "at"))
    per_doc = drops.groupBy("doc", "rid").agg(F.max("n_lines").alias("n_lines"),
                                              F.flatten(F.collect_list("at")).alias("at"))
    return per_doc.mapInPandas(_bitmaps, "doc long, rid long, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[int, int, str]:
    """(lines, dropped lines, the other lines joined)."""
    lines = text.split("\n")
    if keep is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), count=len(lines)).astype(bool)
    return len(lines), int(len(lines) - bits.sum()), "\n".join(x for x, stays in zip(lines, bits, strict=True) if stays)


def _with_bitmaps(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """row (all columns of ``docs``), text (null: empty) and keep (null: every line stays)."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    left = packed(docs).select("row", text.alias("text"), F.coalesce(F.col("row.doc_id").cast("long"), F.lit(OLDEST)).alias("doc"),
                               F.xxhash64(text).alias("rid"))
    maps = keep_bitmaps(docs, min_chars, min_docs)
    return left.join(maps.hint("shuffle_hash"), ["doc", "rid"], "left").select("row", "text", "keep")


def deduplicate(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The columns of ``docs``; texts without the dropped lines, and ``n_chars``, where there is one, to match.
    A null text stays null."""
    @F.pandas_udf("string")
    def cut(text: pd.Series, keep: pd.Series) -> pd.Series:
        return pd.Series([kept_lines(t, k)[2] for t, k in zip(text, keep, strict=True)], dtype=object)

    joined = _with_bitmaps(docs, min_chars, min_docs)
    shorter = F.when(F.col("keep").isNotNull(), cut("text", "keep")).otherwise(F.col("row.text"))
    joined = joined.select("row", shorter.alias("new"), "keep")
    columns = [F.col("new").alias(c) if c == "text" else
               F.when(F.col("keep").isNotNull(), F.length("new").cast(docs.schema[c].dataType)).otherwise(F.col(f"row.{c}")).alias(c)
               if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.select(*columns)


DIGEST = "struct<n_lines long, n_dropped long, kept_sha256 string>"


def digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text, one row a document."""
    @F.pandas_udf(DIGEST)
    def digest(text: pd.Series, keep: pd.Series) -> pd.DataFrame:
        done = [kept_lines(t, k) for t, k in zip(text, keep, strict=True)]
        return pd.DataFrame({"n_lines": [d[0] for d in done], "n_dropped": [d[1] for d in done],
                             "kept_sha256": [hashlib.sha256(d[2].encode("utf-8", "surrogatepass")).hexdigest() for d in done]})

    joined = _with_bitmaps(fold_docs(docs), min_chars, min_docs)
    return joined.select(F.col("row.doc_id").alias("doc_id"), digest("text", "keep").alias("d")).select("doc_id", "d.*")
