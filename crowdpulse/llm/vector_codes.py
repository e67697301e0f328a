"""Product codes of embedding vectors, trained by member-resident Lloyd rounds.

A vector becomes integers (floor of ``SCALE`` times each component), cut into equal consecutive parts; each part position has
a codebook, and the code of a vector lists the nearest entry of every position.

Training. Parts live where their entry's owner is: partition ``owner(position, entry, salt)`` holds weighted members. In a
round each owner sends the sums of its resident members, at most positions x entries rows of fixed width, which make the new
codebook; then every partition compares its members with the new codebook in place. Members that keep their entry stay where
they are (cached, spilling to disk); only those that change entry go through the shuffle, and the union of both, partitioned
alike, is the next round's state. Equal parts of one batch travel as one member with a weight, and the salt spreads an entry
over a quarter of all partitions, so neither a repeated vector nor a huge entry gathers in one task. The codebook (a few
hundred integer rows) is all that reaches the driver. Lost executors: state is recomputed from the shuffles, and every third
round is checkpointed in the shared folder. The final assignment is one pass over the vectors.

Defined cases: a null vector, or one with null or non-finite components, is dropped. Part positions have ceil(n / positions)
components, the last ones filled with zeros; n is the length of the first vector (by id, nulls last, then by value), and a
vector of another length keeps its row with null code and error. Components beyond +-2^24 units are taken as +-2^24, so that
sums stay exact. Codebooks start from distinct ids (repeated rows of an id count once, its smallest vector); with fewer ids
the codebooks are shorter. Repeated rows are members each, and get a row each. An empty table gives an empty result, as does
one without usable vectors. Null ids and labels are kept; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdpulse.llm.common import small, stash
from crowdpulse.session import checkpoint_root

SCALE = 4096
POSITIONS, ENTRIES, ROUNDS = 8, 16, 6
LIMIT = 1 << 24
#: Members that a partition holds on average, and those that are compared at a time.
PARTITION_MEMBERS, BLOCK = 1 << 21, 1 << 16
CHECKPOINT_EVERY = 3
#: Rows of label sums (two numbers each) up to which their side of the join is broadcast: 16 MB.
BROADCAST_LABELS = 1_000_000


@dataclass(frozen=True)
class Codebooks:
    """entries[position, entry, component]; ``size`` is the vectors' length."""
    entries: np.ndarray
    size: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(c: str) -> Column:
    """No null and only finite components (a comparison with null or NaN fails)."""
    return F.forall(F.col(c).cast("array<double>"), lambda x: F.abs(x) < F.lit(float("inf")))


def parts_of(vectors: pa.Array, size: int, positions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``size`` components, and the integer parts of these: (rows, positions, width)."""
    fits = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False) == size)
    flat = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    whole = np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT).astype(np.int64)
    width = -(-size // positions)
    return fits, np.pad(whole, ((0, 0), (0, width * positions - size))).reshape(-1, positions, width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance, in exact integers; the lower index wins a tie."""
    best, index = np.full(len(parts), np.iinfo(np.int64).max), np.zeros(len(parts), np.int64)
    for e, entry in enumerate(book):
        gap = parts - entry
        far = np.einsum("ij,ij->i", gap, gap)
        closer = far < best
        best, index = np.where(closer, far, best), np.where(closer, e, index)
    return index, best


# --- training -------------------------------------------------------------------------------------------------------------

Member = tuple  # (partition, (position, entry, salt, parts, weights))


def partition_of(key: int) -> int:
    return key


def owner(position: int, entry: int, salt: int, partitions: int) -> int:
    """Entries begin at scattered partitions and go round from there, one partition a salt."""
    start = (position * ENTRIES + entry) * 0x9E3779B1 % (1 << 32) * partitions >> 32
    return (start + salt) % partitions


def narrow(parts: np.ndarray) -> np.ndarray:
    top = int(np.abs(parts).max(initial=0))
    return parts.astype(np.int16 if top < 1 << 15 else np.int32)


def salts_of(parts: np.ndarray, salts: int) -> np.ndarray:
    """A salt from the part and the number of the task, so that copies from many tasks spread, and a repeated task agrees."""
    h = np.full(len(parts), (TaskContext.get().partitionId() + 1) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for c in range(parts.shape[1]):
        h = (h ^ parts[:, c].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(salts)).astype(np.int64)


def sent(position: int, entries: np.ndarray, salts: np.ndarray, parts: np.ndarray, weights: np.ndarray, partitions: int) -> Iterator[Member]:
    """Members as one block an entry and salt, each with its owner's partition."""
    order = np.lexsort((salts, entries))
    cuts = np.flatnonzero(np.diff(entries[order]) | np.diff(salts[order])) + 1
    for some in np.split(order, cuts) if len(order) else []:
        e, s = int(entries[some[0]]), int(salts[some[0]])
        yield owner(position, e, s, partitions), (position, e, s, narrow(parts[some]), weights[some])


BLOCK_SCHEMA = pa.schema([*[(c, pa.int32()) for c in ("to", "p", "e", "s", "bytes")], ("parts", pa.binary()), ("weights", pa.binary())])


def dealt(vectors: DataFrame, books: Codebooks, partitions: int, salts: int) -> RDD:
    """The first assignment: each batch's distinct parts, weighted, sent to their owners."""
    entries, size = books.entries, books.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, parts = parts_of(batch.column(0), size, len(entries))
            out: list[list] = [[] for _ in BLOCK_SCHEMA]
            for p in range(len(entries)):
                members, weights = np.unique(parts[:, p], axis=0, return_counts=True)
                index, _ = nearest(members, entries[p])
                for to, (_, e, s, own, w) in sent(p, index, salts_of(members, salts), members, weights, partitions):
                    for column, x in zip(out, (to, p, e, s, own.itemsize, own.tobytes(), w.astype(np.int64).tobytes()), strict=True):
                        column.append(x)
            yield pa.record_batch([pa.array(column, kind) for column, kind in zip(out, BLOCK_SCHEMA.types, strict=True)], schema=BLOCK_SCHEMA)

    width = entries.shape[2]
    kinds = {2: np.int16, 4: np.int32}
    rows = vectors.mapInArrow(run, "to int, p int, e int, s int, bytes int, parts binary, weights binary").rdd
    members = rows.map(lambda r: (r.to, (r.p, r.e, r.s, np.frombuffer(r.parts, kinds[r.bytes]).reshape(-1, width), np.frombuffer(r.weights, np.int64))))
    return members.partitionBy(partitions, partition_of)


def gathered(blocks: Iterator[Member]) -> Iterator[tuple]:
    """Blocks of one (position, entry, salt), joined up to ``BLOCK`` members."""
    held: dict[tuple, tuple[list, list]] = {}
    sizes: dict[tuple, int] = defaultdict(int)
    for _, (p, e, s, parts, weights) in blocks:
        own = held.setdefault((p, e, s), ([], []))
        own[0].append(parts)
        own[1].append(weights)
        sizes[p, e, s] += len(weights)
        if sizes[p, e, s] >= BLOCK:
            del held[p, e, s], sizes[p, e, s]
            yield p, e, s, np.concatenate(own[0]), np.concatenate(own[1])
    for key, own in held.items():
        yield *key, np.concatenate(own[0]), np.concatenate(own[1])


def compared(state: RDD, books: np.ndarray, partitions: int) -> RDD:
    """Every member compared where it is: (partition, block, stays)."""
    def run(blocks: Iterator[Member]) -> Iterator[tuple]:
        here = TaskContext.get().partitionId()
        for p, e, s, parts, weights in gathered(blocks):
            index, _ = nearest(parts.astype(np.int64), books[p])
            same = index == e
            if same.any():
                yield here, (p, e, s, parts[same], weights[same]), True
            if not same.all():
                gone = ~same
                for to, block in sent(p, index[gone], np.full(int(gone.sum()), s), parts[gone], weights[gone], partitions):
                    yield to, block, False
    return state.mapPartitions(run, preservesPartitioning=True)


def sums_of(blocks: Iterator[Member]) -> Iterator[tuple]:
    """Sums and counts of the resident members, an array for each position and entry."""
    totals: dict[tuple, np.ndarray] = {}
    for _, (p, e, _, parts, weights) in blocks:
        total = np.append((parts.astype(np.int64) * weights[:, None]).sum(axis=0), weights.sum())
        totals[p, e] = totals[p, e] + total if (p, e) in totals else total
    yield from totals.items()


def updated(state: RDD, books: np.ndarray) -> np.ndarray:
    positions, entries, _ = books.shape
    totals = state.mapPartitions(sums_of).reduceByKey(np.add, min(positions * entries, state.getNumPartitions())).collect()
    new = books.copy()
    for (p, e), total in totals:
        new[p, e] = total[:-1] // total[-1]
    return new


def first_books(vectors: DataFrame, positions: int, entries: int) -> Codebooks | None:
    """The codebooks cut from the vectors of the smallest ids, of which each task names as many as there are entries."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            ids = batch.column(0) if held is None else pa.concat_arrays([held, batch.column(0)])
            ids = ids.unique()
            held = ids.take(pc.sort_indices(ids, null_placement="at_end")[:entries])
        if held is not None:
            yield pa.record_batch([held], names=["vec_id"])

    named = vectors.select("vec_id").mapInArrow(least, T.StructType([vectors.schema["vec_id"]])).distinct()
    ids = [r.vec_id for r in named.orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    if not ids:
        return None
    chosen = F.col("vec_id").isin([i for i in ids if i is not None])
    rows = vectors.where(chosen | F.col("vec_id").isNull() if None in ids else chosen).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    least = rows.orderBy(F.col("vec_id").asc_nulls_last()).collect()
    size = len(least[0].vector)
    fitting = [r.vector for r in least if len(r.vector) == size]
    _, parts = parts_of(pa.array(fitting, pa.list_(pa.float64())), size, positions)
    return Codebooks(np.ascontiguousarray(parts.transpose(1, 0, 2)), size)


def fit(vectors: DataFrame, positions: int = POSITIONS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Train on all rows of (vec_id, vector) that hold usable vectors; None if there are none."""
    spark = vectors.sparkSession
    books = first_books(vectors, positions, entries)
    if books is None or books.size == 0 or not rounds:
        return books
    checkpoint_root(spark)
    rows = vectors.agg(F.count(F.lit(1))).first()[0]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * positions // PARTITION_MEMBERS))
    salts = max(1, partitions // 4)
    state, kept = dealt(vectors.select("vector"), books, partitions, salts), None
    partitions, now = state.getNumPartitions(), books.entries
    for r in range(rounds):
        if r:
            split = compared(state, now, partitions).persist(StorageLevel.MEMORY_AND_DISK)
            if r % CHECKPOINT_EVERY == 0:
                split.checkpoint()
            stay = split.filter(lambda x: x[2]).mapPartitions(lambda xs: (x[:2] for x in xs), preservesPartitioning=True)
            moved = split.filter(lambda x: not x[2]).map(lambda x: x[:2]).partitionBy(partitions, partition_of)
            state = stay.union(moved)
            assert state.getNumPartitions() == partitions
        now = updated(state, now)
        if r:
            if kept is not None:
                kept.unpersist()
            kept = split
    if kept is not None:
        kept.unpersist()
    return Codebooks(now, books.size)


# --- codes ----------------------------------------------------------------------------------------------------------------


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The rows of ``vectors`` with ``code`` (an entry for each position) and ``error`` in place of ``vector``."""
    entries, size = books.entries, books.size
    others = [c for c in vectors.columns if c != "vector"]
    schema = T.StructType([vectors.schema[c] for c in others] + [T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    at, beside = vectors.columns.index("vector"), [vectors.columns.index(c) for c in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, parts = parts_of(batch.column(at), size, len(entries))
            found = [nearest(parts[:, p], book) for p, book in enumerate(entries)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(np.where(fits, len(entries), 0))]).astype(np.int32)
            code = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()), mask=pa.array(~fits))
            error = np.zeros(len(fits), np.int64)
            error[fits] = sum(far for _, far in found)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in beside] + [code, pa.array(error, mask=~fits)],
                                             names=[*others, "code", "error"])
    return vectors.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``vector``: the components that each code stands for."""
    entries, size = books.entries, books.size
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in book]) for book in entries])
    parts = F.flatten(F.transform(F.col("code"), lambda e, p: F.get(F.get(table, p), e)))
    return codes.withColumn("vector", F.transform(F.slice(parts, 1, size), lambda x: x.cast("double") / SCALE))


def kept_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, label and vector (doubles) of the rows with usable vectors."""
    return embeddings.where(usable(vector)).select("vec_id", "label", F.col(vector).cast("array<double>").alias("vector"))


def hex_code(code: Column) -> Column:
    return F.array_join(F.transform(code, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")


def digests(embeddings: DataFrame) -> DataFrame:
    """vec_id, code as hex, error, label_error, codebooks_sha256, label."""
    vectors = kept_vectors(embeddings)
    books = fit(vectors.select("vec_id", "vector"))
    if books is None or books.size == 0:
        none = vectors.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"), "label")
        return none.select("vec_id", "code", "error", F.col("error").alias("label_error"),
                           F.lit(books.digest() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"), "label")
    coded = stash(encode(vectors, books).select("vec_id", "label", hex_code(F.col("code")).alias("code"), "error"), "vector-codes")
    per_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    labels = per_label.agg(F.count(F.lit(1))).first()[0]
    joined = coded.join(small(per_label, labels, BROADCAST_LABELS), F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"), "label")
