import hashlib
import random
import zlib

import numpy as np
import pytest

from crowdpulse.llm import prefix_trie as pt

DDL = "conv_id long, turn long, role string, text string, conv string, depth int, shard string, l0 string"


def plain(rows):
    """The trie as a dictionary of turn sequences."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            h = hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, h[:15], h[15:30]), (r, t)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    built = {c: own.get(c - c % 5, [])[:zlib.crc32(str(c).encode()) % 9] + v[zlib.crc32(str(c).encode()) % 9:] for c, v in own.items()}
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [0, 0] for p in members}
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, own_members in members.items():
        saved = (len(own_members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += kids[p] == 0
            below[p[:d]][1] += saved
    out = []
    for p, m in members.items():
        end = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], *below[p], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(seed, n=40):
    rng = random.Random(seed)
    data = []
    for c in range(n):
        length = rng.choice([0, 1, 2, 3, 5, 8, 12])
        shared = rng.random() < 0.4
        for t in range(length):
            text = f"common {t}" if shared and t < 3 else rng.choice(["a", "b", "é", "", None, f"own {c} {t}"])
            data.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]) if not shared else "user", text))
    data += data[3:6] + [(None, 1, "user", "lost"), (7, 0, "user", "x" * 30_000), (-3, 0, "user", "below"), (-5, 0, "user", "source"), (1 << 40, 0, None, None)]
    data += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(4)]  # many copies of one conversation
    rng.shuffle(data)
    return data


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in data], DDL).repartition(3)


def got(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted([tuple(r[c] for c in names) for r in df.collect()], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_against_a_plain_trie(spark, seed):
    data = rows(seed)
    assert got(pt.nodes(frame(spark, data))) == plain(data)


def test_conversations_cut_into_fragments(spark, monkeypatch):
    """Fragments of three turns: long shared conversations stand in many shards, and sums cross their bounds."""
    monkeypatch.setattr(pt, "CUT", 3)
    data = rows(3, 25) + [(c, t, "user", f"long {t if t < 30 else (c, t)}") for c in (200, 203, 205) for t in range(45)]
    assert got(pt.nodes(frame(spark, data))) == plain(data)


def test_one_conversation_over_many_partitions(spark):
    """All turns in one conversation, most of them equal: positions run on over the partitions."""
    data = [(4, 0, "user", "again")] * 300 + [(4, i, "user", f"t{i}") for i in range(1, 200)]
    turns = pt.positioned(pt.turns_of(frame(spark, data)))
    assert sorted(r.position for r in turns.select("position").collect()) == list(range(1, 500))
    assert got(pt.nodes(frame(spark, data))) == plain(data)


def test_many_ids_end_at_one_node(spark):
    """Ids of several chunks are hashed in numerical order."""
    data = [(c, t, "user", f"t{t}") for c in range(0, 60_000, 997) for t in range(12)]
    assert got(pt.nodes(frame(spark, data))) == plain(data)


def test_turnless_and_empty(spark):
    lone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    assert got(pt.nodes(frame(spark, [(lone, 0, "user", "x")]))) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert pt.nodes(spark.createDataFrame([], DDL)).count() == 0
    assert pt.nodes(frame(spark, [(None, 0, "user", "x")])).count() == 0


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    lo, hi = rng.integers(0, 50, 3000).astype(np.uint64), rng.integers(0, 1 << 60, 3000).astype(np.uint64)
    table = pt.NodeTable(*pt.distinct(lo, hi))
    slots = table.slots(lo, hi)
    assert sorted(set(slots.tolist())) == list(range(len(set(zip(lo.tolist(), hi.tolist())))))
    assert (table.slots(lo, hi + np.uint64(1 << 61)) == -1).all()
