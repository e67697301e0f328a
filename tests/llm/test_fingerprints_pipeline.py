import hashlib
import re

import corpus_pipeline
from corpus import frame, rows, words
from test_line_dedup import brute as line_brute
from test_near_dedup import brute as near_brute

from crowdpulse.llm import fingerprints as fp


def pieces(t):
    return set(re.findall(r"[^\n]{1,%d}" % fp.PIECE, t))


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, data):
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in fp.fingerprints(frame(spark, data)).collect()}
    ids = {i: t or "" for i, t in data}
    order = sorted(ids, key=lambda i: fp.FIRST if i is None else i)
    assert len(got) == len(ids)
    prints = {}
    for n, i in enumerate(order):
        text, after = ids[i], ids[order[(n + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i, len(text), hashlib.sha256(edited.encode()).hexdigest()]
        assert abs(r.near_edited - alike(pieces(text), pieces(edited))) < 1e-9
        assert abs(r.near_next - alike(pieces(text), pieces(after))) < 1e-9
        for t, f in ((text, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(t, f) == f
    assert len(set(prints.values())) == len({frozenset(pieces(t)) for t in prints})


def test_against_brute_force(spark):
    check(spark, [d for d in rows() if "another" not in (d[1] or "") and d != (None, None)])
    check(spark, [(5, "alone " * 100)])
    check(spark, [(1, ""), (2, None), (3, "same"), (4, "same")])


def test_texts_that_share_an_id_and_empty_table(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (1, "b"), (None, None)])
    assert fp.fingerprints(df).count() == 3 and fp.fingerprints(df.limit(0)).count() == 0


def write(spark, path, docs, bench, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    bench.write.parquet(f"{path}/benchmark.parquet")
    labels.write.parquet(f"{path}/labels.parquet")


def test_pipeline_stage_by_stage(spark, tmp_path):
    import random
    rng = random.Random(12)
    data = rows() + [(2000 + i, words(rng, 30) + (" numbskull " * 3 if i % 3 == 0 else " ") + words(rng, 10)) for i in range(90)]
    item = words(rng, 30)
    data += [(3000, words(rng, 200) + " " + item + " " + words(rng, 9)), (3001, words(rng, 50))]
    docs = frame(spark, data).select("doc_id", "text", "lang", "source", "n_chars")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    labels = spark.createDataFrame([(2000 + i, 1, int(i % 3 == 0)) for i in range(80)] + [(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    write(spark, tmp_path, docs, bench, labels)
    at, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        assert name == "mixing" or stage(spark, at, str(tmp_path)).columns == docs.columns
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [(r.doc_id, r.text) for r in at.collect()] if name != "mixing" else [r.doc_id for r in at.collect()]
    clean = [(i, t) for i, t in data if "numbskull" not in (t or "")]
    assert sorted(map(str, kept["toxicity"])) == sorted(map(str, clean))
    want = {(x[0], x[3]) for x in line_brute(clean, 40, 5)}
    assert {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in kept["line_dedup"]} == want
    smallest = near_brute([d for d in kept["line_dedup"] if d[0] != 7], 5, 80)
    assert {i for i, _ in kept["near_dedup"] if i not in (None, 7)} == {i for i, root in smallest.items() if i == root}
    assert {i for i, _ in kept["decontamination"]} == {i for i, _ in kept["near_dedup"]} - {3000}
    assert sorted(map(str, kept["mixing"])) == sorted(str(i) for i, _ in kept["decontamination"])
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(map(str, kept["mixing"]))
