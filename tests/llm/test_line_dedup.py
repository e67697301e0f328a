import hashlib

from corpus import frame, rows

from crowdpulse.llm import line_dedup as ld

BLANKS = " \t\n\x0b\x0c\r"
AZ = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(data, min_chars, min_docs):
    holders = {}
    for i, t in data:
        for line in (t or "").split("\n"):
            key = line.strip(BLANKS).translate(AZ)
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(ld.OLDEST if i is None else i)
    out = []
    for i, t in data:
        me, lines = ld.OLDEST if i is None else i, (t or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(x.strip(BLANKS).translate(AZ), ())) < min_docs or max(h) == me]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, data, **options):
    df = frame(spark, data)
    got = sorted([tuple(r) for r in ld.digests(df, **options).collect()], key=str)
    assert got == brute(data, options.get("min_chars", 40), options.get("min_docs", 5))
    kept = ld.deduplicate(df, **options)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    texts = sorted(str((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest())) for r in kept.collect())
    assert texts == sorted(str((g[0], g[3])) for g in got)
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text is not None)


def test_against_brute_force(spark):
    check(spark, rows())


def test_a_line_in_every_document_spans_partitions(spark):
    line = "É shared line with more than forty code points in it, yes"
    data = [(i, f"{line}\nown {i}\n  {line.upper().replace('É', 'É')} \t") for i in range(300)] + [(None, line), (None, line)]
    check(spark, data)
    check(spark, data, min_docs=2, min_chars=3)


def test_four_holders_keep_all_and_empty_table(spark):
    line = "x" * 40
    check(spark, [(i, line) for i in range(4)] + [(3, line), (9, "x" * 39), (10, "x" * 39), (11, None)])
    assert ld.digests(frame(spark, [])).count() == 0
