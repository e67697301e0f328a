"""Prefix trie of conversations: what they share from their first turn on, and what a prefix cache saves.

A node is a distinct sequence of first d turns; the conversations that begin with it are its members. Its digest is the sum,
in two lanes of 64 bits, of a keyed hash of (position, role, text) over the sequence, so that digests of a conversation's
prefixes are running sums and a long conversation need not stand in one task.

Node tables. Conversations are dealt to shards of bounded size, whole up to ``CUT`` turns and in fragments of ``CUT`` turns
beyond. A shard lists its distinct prefix digests, gives each a slot by a minimal perfect hash (levels of bit arrays and
their ranks) and checks it against the digest kept in the slot; counts are scattered into flat numpy arrays. The shards'
partial counts meet by digest, which gives a node's members and its smallest one. Then each shard accumulates in depth order
through its parent slots, where every node counts in the one shard that holds its smallest member there. The sum of the
shards' partial results is exact: a node's smallest member passes through all ancestors of the node. The number of jobs
doesn't depend on depth, and a node shared by most conversations is one row a shard in every shuffle. A fragment's first
node, whose parent is in another shard, hands its accumulated sums to all earlier turns of its conversation, as sums over
the fragments behind each.

Defined cases: turns are ordered by turn, null first, then by the MD5 of role and text; equal rows are turns each. Null role
or text is empty. Rows without a conv_id belong to no conversation and are left out. An empty table gives an empty result.
c - c % 5 rounds down for negative ids, so that ids -5 to -1 share a source. Extra columns are ignored. Long texts are
hashed where they are read and do not travel. Two sequences with equal digests (120 bits a turn, 128 a sequence) would be
one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import stash, text_or_empty

#: Rows of a shard on average, and turns of a conversation that stay together.
SHARD_ROWS, CUT = 1 << 18, 4096
#: The rebuilding: ids that share a source, and one more than the source turns taken at most.
SIBLINGS, HEADS = 5, 9
#: An ended node's ids are written in chunks of ids that agree in all but these lowest bits.
CHUNK_BITS = 12

LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def unsigned(column: pa.Array) -> np.ndarray:
    return signed(column).view(np.uint64)


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def terms(depth: np.ndarray, t0: np.ndarray, t1: np.ndarray) -> list[np.ndarray]:
    """What the turn at ``depth`` adds to each lane; the root adds nothing."""
    at = mixed(depth.astype(np.uint64) * LANES[0] + LANES[1])
    return [np.where(depth == 0, np.uint64(0), mixed(mixed(t0 ^ (at + lane)) + t1 * lane)) for lane in LANES]


def running(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each of ``starts``."""
    total = np.cumsum(x, dtype=x.dtype)
    return total - np.repeat(total[starts] - x[starts], np.diff(np.append(starts, len(x))))


def starts_of(*keys: np.ndarray) -> np.ndarray:
    changes = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for k in keys:
        changes |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(changes) + 1]).astype(np.int64)


def shard_count(rows: DataFrame) -> int:
    counted = rows.agg(F.count(F.lit(1))).first()[0]
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-counted // SHARD_ROWS))


# --- turns and their positions --------------------------------------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, turn, t0, t1 (of the MD5 of role and text), bytes of the text, and a number that tells equal rows apart."""
    role, text = text_or_empty("role"), text_or_empty("text")
    h = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    named = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                                                     h.alias("h"), F.octet_length(text).cast("long").alias("bytes"))
    part = [F.conv(F.substring("h", at, 15), 16, 10).cast("long").alias(f"t{i}") for i, at in enumerate((1, 16))]
    return named.select("conv", "turn", *part, "bytes", F.monotonically_increasing_id().alias("twin"))


POSITIONED = "conv long, t0 long, t1 long, bytes long, position long, shard int, edge int"


def positioned(turns: DataFrame) -> DataFrame:
    """conv, t0, t1, bytes and the turn's position in its conversation, from 1. Turns are range-partitioned by their order, so
    that a conversation can take many partitions; what earlier partitions hold of it comes in as an offset (the driver gets
    the first and the last row of each partition)."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("t0"), F.col("t1"), F.col("twin")]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, conv, count, held = TaskContext.get().partitionId(), None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            convs = signed(batch.column(0))
            starts = starts_of(convs)
            position = running(np.ones(len(convs), np.int64), starts)
            if convs[0] == conv:
                position[: starts[1] if len(starts) > 1 else None] += count
            edge = np.zeros(len(convs), np.int32)
            if held is not None:
                yield pa.record_batch([*held, pa.array(held_edge)], names=names)
            else:
                edge[0] = 1
            conv, count = convs[-1], int(position[-1])
            held = [*batch.select(["conv", "t0", "t1", "bytes"]).columns, longs(position), pa.array(np.full(len(convs), shard, np.int32))]
            held_edge = edge
        if held is not None:
            held_edge[-1] |= 2
            yield pa.record_batch([*held, pa.array(held_edge)], names=names)

    names = [c.split()[0] for c in POSITIONED.split(", ")]
    local = stash(turns.repartitionByRange(shard_count(turns), *order).sortWithinPartitions(*order).mapInArrow(number, POSITIONED), "trie-positions")
    edges = local.where("edge > 0").select("shard", "edge", "conv", "position").collect()
    first = {r.shard: r.conv for r in edges if r.edge & 1}
    last = {r.shard: (r.conv, r.position) for r in edges if r.edge & 2}
    carry, conv, count = [], None, 0
    for shard in sorted(first):
        before = count if first[shard] == conv else 0
        if before:
            carry.append((shard, conv, before))
        whole = first[shard] == last[shard][0]
        conv, count = last[shard][0], last[shard][1] + (before if whole else 0)
    if not carry:
        return local.select("conv", "t0", "t1", "bytes", "position")
    given = F.broadcast(turns.sparkSession.createDataFrame(carry, "shard int, conv long, before long"))
    return local.join(given, ["shard", "conv"], "left").select("conv", "t0", "t1", "bytes", (F.col("position") + F.coalesce("before", F.lit(0))).alias("position"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv, depth, t0, t1, bytes, length of the rebuilt conversations, a textless row of depth 0 for each: the first h turns of
    the source conversation, then the own turns after the first h."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS))
    named = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.pmod("conv", F.lit(SIBLINGS))).alias("source"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    info = stash(named.join(sizes.select(F.col("conv").alias("source"), F.col("n").alias("there")), "source", "left")
                 .select("conv", "source", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-sizes")
    own = (turns.join(info, "conv").where("position > h")
           .select("conv", (F.col("position") - F.col("h") + F.col("taken")).alias("depth"), "t0", "t1", "bytes", "length"))
    heads = turns.where((F.col("position") < HEADS) & (F.pmod("conv", F.lit(SIBLINGS)) == 0)).withColumnRenamed("conv", "source")
    copied = heads.join(info, "source").where("position <= taken").select("conv", F.col("position").alias("depth"), "t0", "t1", "bytes", "length")
    zero = F.lit(0).cast("long")
    roots = info.select("conv", zero.alias("depth"), zero.alias("t0"), zero.alias("t1"), zero.alias("bytes"), "length")
    return own.unionByName(copied).unionByName(roots)


PATHS = "conv long, depth long, t0 long, t1 long, bytes long, length long, block long, shard int, l0 long, l1 long"


def paths_of(turns: DataFrame, shards: int) -> DataFrame:
    """The rebuilt rows with their shard and prefix digest (l0, l1); ``block`` numbers the fragments of a conversation."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key, sums = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth, block = (signed(batch.column(i)) for i in (0, 1, 6))
            starts = starts_of(conv, block)
            lanes = [running(x, starts) for x in terms(depth, unsigned(batch.column(2)), unsigned(batch.column(3)))]
            if (conv[0], block[0]) == key:
                for lane, x in zip(lanes, sums, strict=True):
                    lane[: starts[1] if len(starts) > 1 else None] += x
            key, sums = (conv[-1], block[-1]), [lane[-1] for lane in lanes]
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(conv), shard, np.int32)), *map(longs, lanes)], names=names)

    names = [c.split()[0] for c in PATHS.split(", ")]
    block = F.floor(F.col("depth") / CUT).cast("long")
    dealt = rebuilt(turns).withColumn("block", block).repartition(shards, "conv", "block").sortWithinPartitions("conv", "depth")
    return stash(dealt.mapInArrow(summed, PATHS), "trie-paths")


def with_carry(paths: DataFrame) -> DataFrame:
    """c0, c1 beside each row: what the earlier fragments of its conversation add to the digest."""
    two64, two63 = (F.lit(str(1 << n)).cast("decimal(38,0)") for n in (64, 63))
    ends = paths.where(F.col("length") >= CUT).groupBy("conv", "block").agg(*[F.max_by(c, "depth").cast("decimal(38,0)").alias(c) for c in ("l0", "l1")])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    wrapped = [F.pmod(F.coalesce(F.sum(f"l{i}").over(earlier), F.lit(0)).cast("decimal(38,0)"), two64) for i in range(2)]
    carry = ends.select("conv", "block", *[F.when(x >= two63, x - two64).otherwise(x).cast("long").alias(f"c{i}") for i, x in enumerate(wrapped)])
    zero = F.lit(0).cast("long")
    short = paths.where(F.col("length") < CUT).withColumns({"c0": zero, "c1": zero})
    return short.unionByName(paths.where(F.col("length") >= CUT).join(carry, ["conv", "block"]).select(*short.columns))


# --- node tables ----------------------------------------------------------------------------------------------------------


class NodeTable:
    """Slots 0 to n-1 for n distinct digests. A level keeps a bit wherever exactly one of the digests left over falls; that
    digest's slot is the bit's rank. Lookups compare the digest in the slot, so that foreign digests get -1."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.lo, self.hi = np.empty_like(lo), np.empty_like(hi)
        taken = 0
        while len(lo):
            at = self._at(lo, hi, len(self.levels), 2 * len(lo))
            alone = np.bincount(at, minlength=2 * len(lo)) == 1
            ranks = taken + np.cumsum(alone) - 1
            placed = alone[at]
            slots = ranks[at[placed]]
            self.lo[slots], self.hi[slots] = lo[placed], hi[placed]
            self.levels.append((alone, ranks))
            taken += int(placed.sum())
            lo, hi = lo[~placed], hi[~placed]

    @staticmethod
    def _at(lo: np.ndarray, hi: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(mixed(lo + np.uint64((level + 1) * int(LANES[0]) % (1 << 64))) ^ hi) % np.uint64(size)).astype(np.int64)

    def slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out, left = np.full(len(lo), -1, np.int64), np.arange(len(lo))
        for level, (alone, ranks) in enumerate(self.levels):
            at = self._at(lo[left], hi[left], level, len(alone))
            hit = alone[at]
            slot = ranks[at[hit]]
            same = (self.lo[slot] == lo[left[hit]]) & (self.hi[slot] == hi[left[hit]])
            out[left[hit][same]] = slot[same]
            left = left[~hit]
        return out


def distinct(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hi, lo))
    first = starts_of(lo[order], hi[order]) if len(order) else np.empty(0, np.int64)
    return lo[order[first]], hi[order[first]]


PARTIAL = "shard int, l0 long, l1 long, p0 long, p1 long, depth long, bytes long, n long, least long, going long"


def partial_nodes(paths: DataFrame) -> DataFrame:
    """Each shard's nodes: digest, parent's digest, depth, bytes, members there, the smallest, and how many go on."""
    names = [c.split()[0] for c in PARTIAL.split(", ")]
    at = {c: i for i, c in enumerate(paths.columns)}

    def table_of(shard: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        def column(c: str) -> np.ndarray:
            return np.concatenate([signed(b.column(at[c])) for b in rows])

        depth, conv = column("depth"), column("conv")
        lanes = [(column(f"l{i}").view(np.uint64) + column(f"c{i}").view(np.uint64)) for i in range(2)]
        parents = [lane - own for lane, own in zip(lanes, terms(depth, column("t0").view(np.uint64), column("t1").view(np.uint64)), strict=True)]
        table = NodeTable(*distinct(*lanes))
        slot, size = table.slots(*lanes), len(table.lo)
        count, least, going = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
        np.add.at(count, slot, 1)
        np.minimum.at(least, slot, conv)
        np.add.at(going, slot, (depth < column("length")).astype(np.int64))
        same = []
        for x in (*parents, depth, column("bytes")):  # alike in all rows of a slot
            own = np.zeros(size, x.dtype)
            own[slot] = x
            same.append(longs(own))
        return pa.record_batch([pa.array(np.full(size, shard, np.int32)), longs(table.lo), longs(table.hi), *same, longs(count), longs(least), longs(going)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, rows = None, [], 0
        for batch in batches:
            shards = signed(batch.column(at["shard"]))
            bounds = np.append(starts_of(shards), len(shards)) if len(shards) else []
            for a, b in zip(bounds[:-1], bounds[1:]):
                if held and (int(shards[a]) != shard or rows >= 4 * SHARD_ROWS):
                    yield table_of(shard, held)
                    held, rows = [], 0
                shard = int(shards[a])
                held.append(batch.slice(a, b - a))
                rows += b - a
        if held:
            yield table_of(shard, held)

    return paths.mapInArrow(run, PARTIAL)


SUMS = ("l0 long, l1 long, leaves long, saved long, children long, conv_id long, depth long, parent_conv_id long, n_convs long, p0 long, p1 long, "
        "cut_conv long, cut_depth long")


def accumulated(partial: DataFrame, shards: int) -> DataFrame:
    """Every shard's share in its nodes' sums; the node's own figures stand in the row of the shard that has its smallest member.
    A node whose parent isn't in the shard has cut_conv, a conversation that leads to it, and its children's row apart."""
    names = [c.split()[0] for c in SUMS.split(", ")]
    node = Window.partitionBy("l0", "l1")
    known = partial.select("*", F.sum("n").over(node).alias("members"), F.min("least").over(node).alias("rep"), F.sum("going").over(node).alias("on"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        col = {c: signed(rows.column(c)) for c in rows.schema.names}
        lanes, parents = [col[c].view(np.uint64) for c in ("l0", "l1")], [col[c].view(np.uint64) for c in ("p0", "p1")]
        table = NodeTable(*distinct(*lanes))
        slot, size = table.slots(*lanes), len(table.lo)
        flat = {}
        for c in ("p0", "p1", "depth", "bytes", "members", "rep", "on"):
            flat[c] = np.zeros(size, np.int64)
            flat[c][slot] = col[c]
        least = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, col["least"])
        parent = np.full(size, -1, np.int64)
        parent[slot] = table.slots(*parents)
        parent[flat["depth"] == 0] = -1
        own = least == flat["rep"]
        leaves = (own & (flat["on"] == 0)).astype(np.int64)
        saved = np.where(own, (flat["members"] - 1) * flat["bytes"], 0)
        children = np.zeros(size, np.int64)
        inside = parent >= 0
        np.add.at(children, parent[own & inside], 1)
        order = np.argsort(-flat["depth"], kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1):
            up = same[inside[same]]
            np.add.at(leaves, parent[up], leaves[up])
            np.add.at(saved, parent[up], saved[up])
        cut = ~inside & (flat["depth"] > 0)
        of_parent = np.where(inside, flat["rep"][parent], 0)
        no = np.zeros(size, bool)

        def given(x: np.ndarray, there: np.ndarray) -> pa.Array:
            return pa.array(x, pa.int64(), mask=~there)

        yield pa.record_batch([longs(table.lo), longs(table.hi), longs(leaves), longs(saved), longs(children), given(flat["rep"], own), given(flat["depth"], own),
                               given(of_parent, own & inside), given(flat["members"], own), given(flat["p0"], own), given(flat["p1"], own),
                               given(least, cut), given(flat["depth"], cut)], names=names)
        above = np.flatnonzero(own & cut)
        if len(above):
            zero, none = longs(np.zeros(len(above), np.int64)), given(least[above], no[above])
            yield pa.record_batch([longs(flat["p0"][above]), longs(flat["p1"][above]), zero, zero, longs(np.ones(len(above), np.int64)), *[none] * 8], names=names)

    return known.repartitionById(shards, "shard").mapInArrow(run, SUMS)


def cut_sums(sums: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows that bring the sums of nodes at cuts to all earlier turns of their conversations."""
    cuts = sums.where("cut_conv IS NOT NULL").groupBy(F.col("cut_conv").alias("conv"), F.floor(F.col("cut_depth") / CUT).cast("long").alias("block")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    blocks = cuts.unionByName(paths.where(F.col("length") >= CUT).select("conv", "block").distinct()
                              .select("conv", "block", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")))
    later = Window.partitionBy("conv").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    merged = blocks.groupBy("conv", "block").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    behind = merged.select("conv", "block", F.sum("leaves").over(later).alias("leaves"), F.sum("saved").over(later).alias("saved")).where("leaves > 0 OR saved > 0")
    none = [F.lit(None).cast("long").alias(c.split()[0]) for c in SUMS.split(", ")[5:]]
    return paths.where(F.col("length") >= CUT).join(behind, ["conv", "block"]).select("l0", "l1", "leaves", "saved", F.lit(0).cast("long").alias("children"), *none)


# --- results --------------------------------------------------------------------------------------------------------------


def ends(paths: DataFrame, shards: int) -> DataFrame:
    """l0, l1, ends_sha256 of the nodes at which conversations end: ids are joined in chunks, a node's chunks hashed in a row."""
    ended = paths.where("depth = length").select("l0", "l1", "conv", F.shiftright("conv", CHUNK_BITS).alias("chunk"))
    chunks = ended.groupBy("l0", "l1", "chunk").agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for l0, l1, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (l0, l1) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (l0, l1), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], names=["l0", "l1", "ends_sha256"])
        if key is not None:
            yield pa.record_batch([pa.array([x]) for x in (*key, sha.hexdigest())], names=["l0", "l1", "ends_sha256"])

    sorted_chunks = chunks.repartition(shards, "l0", "l1").sortWithinPartitions("l0", "l1", "chunk").select("l0", "l1", "ids")
    return sorted_chunks.mapInArrow(run, "l0 long, l1 long, ends_sha256 string")


def lifted(paths: DataFrame) -> DataFrame:
    """``paths`` with whole prefix digests, the earlier fragments' part added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [longs(unsigned(batch.column(f"l{i}")) + unsigned(batch.column(f"c{i}"))) for i in range(2)]
            yield pa.record_batch([*batch.select(["conv", "depth", "length", "block"]).columns, *both], names=["conv", "depth", "length", "block", "l0", "l1"])

    return paths.mapInArrow(run, "conv long, depth long, length long, block long, l0 long, l1 long")


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: l0, l1 (its digest), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes of shared last turns beneath it, itself included), ends_sha256."""
    turns = positioned(stash(turns_of(conversations), "trie-turns"))
    shards = shard_count(turns)
    plain = paths_of(turns, shards)
    long = plain.where(F.col("length") >= CUT).limit(1).count() > 0
    zero = F.lit(0).cast("long")
    paths = with_carry(plain) if long else plain.withColumns({"c0": zero, "c1": zero})
    whole = lifted(paths) if long else plain.select("conv", "depth", "length", "block", "l0", "l1")
    sums = stash(accumulated(partial_nodes(paths), shards), "trie-sums")
    every = sums.unionByName(cut_sums(sums, whole)) if long else sums
    figures = ("conv_id", "depth", "parent_conv_id", "n_convs", "p0", "p1")
    nodes = every.groupBy("l0", "l1").agg(F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
                                          *[F.max(c).alias(c) for c in figures])
    if long:  # the parent of a node at a cut is known elsewhere
        tops = sums.where("conv_id IS NOT NULL").select(F.col("l0").alias("p0"), F.col("l1").alias("p1"), F.col("conv_id").alias("above"))
        lost = nodes.where("parent_conv_id IS NULL AND depth > 0").join(tops, ["p0", "p1"], "left").withColumn("parent_conv_id", F.col("above")).drop("above")
        nodes = nodes.where("parent_conv_id IS NOT NULL OR depth = 0").unionByName(lost)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(ends(whole, shards), ["l0", "l1"], "left").select(
        "l0", "l1", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def nodes(conversations: DataFrame) -> DataFrame:
    return trie(conversations).drop("l0", "l1")
