"""Document fingerprints as invertible Bloom lookup sketches, in SQL functions only.

A text's paragraphs (long ones in pieces of ``PIECE`` code points, counted from the paragraph's start) are digested to
31 bits; the set of digests goes into a sketch of three subtables: in each, a digest adds itself to one cell's count, XOR
of digests and XOR of their checks. The sketch of ``BASE`` cells per subtable, written out, is the fingerprint.

Subtracting two sketches cancels what the texts share. Peeling then recovers the differing digests: a cell with a count of
plus or minus one whose check fits holds a single digest, which is taken out of its other cells, until nothing is left. The
recovered digests are returned; their number, with both set sizes, gives the likeness (shared over distinct digests). Where
the base sketch is too small for the difference, the pair is tried again with a larger one, hashed anew, until it comes out:
first with room for the difference that the base sketch lets expect (its counts' squares estimate it), then doubled. Base
sketches are peeled inside the row; the larger ones as rows (pair, cell), only cells that hold something, that never leave
their partition; partitions are as many as the digests need.

``versions`` pairs each text with its edited text and the next document. The order of documents comes from a table of
ids only: range-partitioned, numbered inside each partition, and linked across the partitions' borders by a small table.

Defined cases: null text is empty; an empty text has an empty sketch, alike to another empty one (1.0); null ids
come before all others and texts with the same id in the order of their hashes; rows that repeat id and text are one
document; a single document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import fold_docs, row_count, stash

PIECE = 128
BASE = 8            # cells per subtable of the written fingerprint
SUBTABLES = 3
FIRST = -(1 << 63)  # stands for a null id (no document has it)
ROUNDS = 12         # peeling rounds of a base sketch
LARGER_ROUNDS = 5   # and of a larger one, which is retried at twice the size if they don't do
ROOM = 4            # cells a subtable that a larger sketch has for each digest thought to differ
ATTEMPTS = 20       # doublings
PARTITION_CELLS = 1 << 19   # entries of larger sketches in a partition


def digest_set(text: Column) -> Column:
    """Distinct 31-bit digests of the text's pieces."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{PIECE}}}"), F.lit(0)),
                                        lambda p: F.xxhash64(p).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))


def check(k: Column) -> Column:
    return F.xxhash64(k.cast("long"), F.lit(101))


def cell_of(k: Column, t: Column | int, size: Column | int, attempt: Column | int = 0) -> Column:
    """The digest's cell in subtable t of ``size`` cells, counted over all subtables. Each attempt hashes anew, so that
    digests which shared their cells in one sketch part in the next."""
    size = F.lit(size) if isinstance(size, int) else size
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    seed = (F.lit(t) if isinstance(t, int) else t) + SUBTABLES * attempt
    return (F.pmod(F.xxhash64(k.cast("long"), seed.cast("int")), size.cast("long")) + size * t).cast("int")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: an array of one element stands in for a local variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _by_cell(entries: Column, cell, total) -> Column:
    """``total`` of each stretch of entries with one cell, in the order of the cells; linear in the sorted entries."""
    def runs(e: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(e)), lambda i: (i == 1) | (cell(F.element_at(e, i)) != cell(F.element_at(e, F.greatest(i - 1, F.lit(1))))))

        def stretches(f: Column) -> Column:
            return F.zip_with(f, F.concat(F.slice(f, 2, F.size(f)), F.array(F.size(e) + 1)), lambda i, j: _let(F.slice(e, i, j - i), total))

        return _let(first, stretches)

    summed = _let(F.sort_array(entries), runs)
    return F.when(F.size(entries) > 0, F.filter(summed, lambda x: (x["c"] != 0) | (x["k"] != 0) | (x["s"] != 0))).otherwise(F.array().cast(CELLS))


CELLS = "array<struct<cell:int,c:int,k:bigint,s:bigint>>"


def _entry(cell: Column, c: Column, k: Column, s: Column) -> Column:
    return F.struct(cell.cast("int").alias("cell"), c.cast("int").alias("c"), k.cast("long").alias("k"), s.alias("s"))


def _sum(x: Column, c: Column, k: Column, s: Column) -> Column:
    return _entry(x["cell"], x["c"] + c, x["k"].bitwiseXOR(k), x["s"].bitwiseXOR(s))


def _folded(entries: Column) -> Column:
    """Entries struct<cell, c, k, s> summed by cell; cells that come to nothing are left out."""
    def total(own: Column) -> Column:
        return F.aggregate(F.slice(own, 2, F.size(own)), F.element_at(own, 1), lambda x, y: _sum(x, y["c"], y["k"], y["s"]))

    return _by_cell(entries, lambda x: x["cell"], total)


def difference(a: Column, b: Column | None, size: Column | int = BASE, attempt: Column | int = 0) -> Column:
    """array<struct<cell, c, k, s>>: the sketch of ``a`` less that of ``b``. Cells are sums, so both are added up at once. An
    entry is sorted as one number: cell, digest and side."""
    def marks(digests: Column, side: int) -> Column:
        def of(k: Column) -> Column:
            low = F.shiftleft(k.cast("long"), 1).bitwiseOR(F.lit(side).cast("long"))
            return F.array(*[F.shiftleft(cell_of(k, t, size, attempt).cast("long"), 32).bitwiseOR(low) for t in range(SUBTABLES)])
        return F.flatten(F.transform(digests, of))

    def total(own: Column) -> Column:
        def add(x: Column, y: Column) -> Column:
            return _let(F.shiftright(y, 1).bitwiseAND(F.lit(0x7FFFFFFF).cast("long")),
                        lambda k: _sum(x, F.lit(1) - 2 * y.bitwiseAND(F.lit(1).cast("long")).cast("int"), k, check(k)))
        zero = F.lit(0).cast("long")
        return F.aggregate(own, _entry(F.shiftright(F.element_at(own, 1), 32), F.lit(0), zero, zero), add)

    entries = marks(a, 0) if b is None else F.concat(marks(a, 0), marks(b, 1))
    return _by_cell(entries, lambda y: F.shiftright(y, 32), total)


def sketch(digests: Column, size: Column | int = BASE, attempt: Column | int = 0) -> Column:
    """The three subtables' cells that hold something, in order."""
    return difference(digests, None, size, attempt)


def subtracted(a: Column, b: Column) -> Column:
    """The difference of two sketches of one size: what both sets hold is gone."""
    return _folded(F.concat(a, F.transform(b, lambda x: _entry(x["cell"], -x["c"], x["k"], x["s"]))))


def written(cells: Column) -> Column:
    """The base sketch as a string: count.digests.checks in hexadecimal, a comma after each cell."""
    text = F.map_from_entries(F.transform(cells, lambda x: F.struct(x["cell"], F.concat_ws(".", F.hex(x["c"]), F.hex(x["k"]), F.hex(x["s"])))))
    return _let(text, lambda m: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SUBTABLES * BASE - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(""))), ","))


def peeled(difference: Column, size: Column | int, attempt: Column | int = 0) -> Column:
    """array<struct<k, c>> of the digests recovered from a difference (c: 1 only in the first set, -1 only in the second), or
    null if it does not come out. A round takes the single digests of one subtable at once, each of which stands in one
    cell there, out of the other two."""
    size_c = F.lit(size) if isinstance(size, int) else size
    none = F.array().cast("array<struct<k:bigint,c:int>>")

    def step(state: Column, r: Column) -> Column:
        t = r % SUBTABLES

        def single(x: Column) -> Column:
            return (x["cell"] >= size_c * t) & (x["cell"] < size_c * (t + 1)) & (F.abs(x["c"]) == 1) & (x["s"] == check(x["k"]))

        def out(p: Column) -> Column:
            cells = F.filter(F.array(*[cell_of(p["k"], u, size, attempt) for u in range(SUBTABLES)]), lambda at: at != p["cell"])
            return F.transform(cells, lambda at: _entry(at, -p["c"], p["k"], p["s"]))

        def taken(found: Column) -> Column:
            left = _folded(F.concat(F.filter(state["cells"], lambda x: ~single(x)), F.flatten(F.transform(found, out))))
            return F.when(F.size(found) == 0, F.struct(state["cells"].alias("cells"), state["found"].alias("found"), (state["idle"] + 1).alias("idle"))).otherwise(
                F.struct(left.alias("cells"), F.concat(state["found"], F.transform(found, lambda p: F.struct(p["k"].alias("k"), p["c"].alias("c")))).alias("found"),
                         F.lit(0).alias("idle")))

        ended = (F.size(state["cells"]) == 0) | (state["idle"] >= SUBTABLES)
        return F.when(ended, state).otherwise(_let(F.filter(state["cells"], single), taken))

    start = F.struct(difference.alias("cells"), none.alias("found"), F.lit(0).alias("idle"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda st: F.when(F.size(st["cells"]) == 0, st["found"]))


def estimate(difference: Column, a: Column, b: Column) -> Column:
    """About how many digests differ, from the counts of a base difference: the mean over the subtables of the sum of their
    squares, less what the difference of the two set sizes adds to it (standard error about 0.3 of the value)."""
    squares = F.aggregate(difference, F.lit(0.0), lambda acc, x: acc + x["c"] * x["c"]) / SUBTABLES
    gap = (F.size(a) - F.size(b)).cast("double")
    return F.greatest((squares - gap * gap / BASE) * BASE / (BASE - 1), F.abs(gap))


def peel_larger(pairs: DataFrame, key: list[str], attempt: int) -> DataFrame:
    """key, size, ``open`` (cells left) and ``found`` (array<struct<k, c>>) of pairs (key, size, a, b), by sketches of ``size`` cells a
    subtable in rows (pair, cell), kept where they hold something. All rows of a pair stay in their partition.

    At a quarter of a digest a cell nearly all are single somewhere, so that a few rounds solve nearly all pairs; a round
    moves the single digests of one subtable out of the other two, into rows of their own (cells below 0)."""
    def signed(c: str, sign: int) -> Column:
        return F.transform(c, lambda k: F.struct(k.cast("long").alias("k"), F.lit(sign).alias("c")))

    rows = pairs.select(*key, "size", F.explode(F.concat(signed("a", 1), signed("b", -1))).alias("x")).select(*key, "size", "x.k", "x.c")
    rows = rows.withColumn("s", check(F.col("k")))
    cells = [F.struct(cell_of(F.col("k"), t, F.col("size"), attempt).alias("cell"), "c", "k", "s") for t in range(SUBTABLES)]

    def summed(df: DataFrame) -> DataFrame:
        return (df.groupBy(*key, "size", "cell").agg(F.sum("c").cast("int").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("s").alias("s"))
                .where("c <> 0 or k <> 0 or s <> 0"))

    state = summed(rows.select(*key, "size", F.inline(F.array(*cells))))
    for r in range(LARGER_ROUNDS):
        t = r % SUBTABLES
        single = (F.col("cell") >= F.col("size") * t) & (F.col("cell") < F.col("size") * (t + 1)) & (F.abs("c") == 1) & (F.col("s") == check(F.col("k")))
        taken = [F.struct((-1 - F.col("k")).cast("int").alias("cell"), "c", "k", "s")]
        taken += [F.struct(cell_of(F.col("k"), u, F.col("size"), attempt).alias("cell"), (-F.col("c")).alias("c"), F.col("k").alias("k"), F.col("s").alias("s"))
                  for u in range(SUBTABLES) if u != t]
        state = summed(state.select(*key, "size", F.inline(F.when(single, F.array(*taken)).otherwise(F.array(F.struct("cell", "c", "k", "s"))))))
    return state.groupBy(*key, "size").agg(F.sum((F.col("cell") >= 0).cast("int")).alias("open"),
                                   F.collect_list(F.when(F.col("cell") < 0, F.struct("k", "c"))).alias("found"))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Shared over distinct digests, from the two set sizes and the number that differ."""
    union = (a + b + differing) / 2
    return F.when(union == 0, F.lit(1.0)).otherwise((union - differing) / union)


def succession(docs: DataFrame) -> DataFrame:
    """did, h, n, next_did, next_h: each document's key and length, and its successor's key (the last one's: the first)."""
    ids = docs.groupBy("did", "h").agg(F.max("n").alias("n"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = stash(ids.repartitionByRange(parts, "did", "h").sortWithinPartitions("did", "h").withColumn("at", F.monotonically_increasing_id()), "order")
    borders = order.groupBy(F.shiftright("at", 33).alias("part")).agg(F.max("at").alias("last"), F.min("at").alias("first"))
    # one row per partition of the exchange above
    w = Window.orderBy("part")
    ring = borders.select("last", F.coalesce(F.lead("first").over(w), F.first("first").over(w)).alias("after"))
    linked = order.join(F.broadcast(ring), F.col("at") == F.col("last"), "left").withColumn("next_at", F.coalesce("after", F.col("at") + 1))
    then = order.select(F.col("did").alias("next_did"), F.col("h").alias("next_h"), F.col("at").alias("a"))
    return linked.join(then, F.col("next_at") == F.col("a")).select("did", "h", "n", "next_did", "next_h")


def versions(docs: DataFrame) -> DataFrame:
    """did, h, doc_id, n_chars, edited_sha256, and the digest sets own, edited, next of every document."""
    keyed = fold_docs(docs).select(F.coalesce("doc_id", F.lit(FIRST)).alias("did"), F.xxhash64("text").alias("h"), "text")
    links = stash(succession(keyed.select("did", "h", F.length("text").cast("long").alias("n"))), "succession")
    texts = keyed
    if row_count(links) != row_count(keyed):
        texts = texts.dropDuplicates(["did", "h"])
    half = F.floor(F.col("n") / 2).cast("int")
    before = links.select(F.col("did").alias("prev_did"), F.col("h").alias("prev_h"), "n", F.col("next_did").alias("did"), F.col("next_h").alias("h"))
    # what each document gives to the one before it; both joins use the same columns, so they share one exchange of texts
    given = (texts.join(before.hint("shuffle_hash"), ["did", "h"])
             .select(F.col("prev_did").alias("did"), F.col("prev_h").alias("h"), "n", F.expr("left(text, cast(floor(n / 2) as int))").alias("part"),
                     digest_set(F.col("text")).alias("next")))
    both = texts.join(given, ["did", "h"]).withColumn("edited_text", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n").cast("int") - half), F.col("part")))
    doc_id = F.when(F.col("did") != FIRST, F.col("did"))
    return both.select("did", "h", doc_id.alias("doc_id"), F.col("n").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
                       digest_set(F.col("text")).alias("own"), digest_set(F.col("edited_text")).alias("edited"), "next")


def compare(sets: DataFrame, key: list[str], own: str, others: list[str]) -> DataFrame:
    """``sets`` with the base sketch of each of its sets (sketch_<set>), and for each other set the digests in which it differs
    from ``own``: only_<own>_<set>, only_<set>. Base sketches are subtracted and peeled in their row; pairs that differ too
    much for that go on with larger ones."""
    spark, names = sets.sparkSession, [own, *others]
    sketched = sets.withColumns({f"sketch_{x}": sketch(F.col(x)) for x in names})
    less = sketched.withColumns({f"_{x}": subtracted(F.col(f"sketch_{own}"), F.col(f"sketch_{x}")) for x in others})
    about = less.withColumns({f"about_{x}": estimate(F.col(f"_{x}"), F.col(own), F.col(x)) for x in others})
    # a base sketch can't give back more digests than it has cells
    tried = {f"found_{x}": F.when(F.col(f"about_{x}") <= 1.5 * SUBTABLES * BASE, peeled(F.col(f"_{x}"), BASE)) for x in others}
    base = stash(about.withColumns(tried).drop(*[f"_{x}" for x in others]), "base-peeled")
    size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("about") * ROOM, F.lit(4.0 * BASE))))).cast("int")
    kinds = F.array_compact(F.array(*[F.when(F.col(f"found_{x}").isNull(), F.struct(F.lit(i).alias("kind"), F.col(f"about_{x}").alias("about"))) for i, x in enumerate(others)]))
    asked = base.select(*key, *names, F.inline(kinds)).withColumn("size", size)
    entries = base.agg(F.sum(sum(F.size(x).cast("long") for x in names))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries * SUBTABLES // PARTITION_CELLS))
    solved = []
    for attempt in range(1, ATTEMPTS):
        # one exchange deals the pairs out; nothing after it leaves its partition
        pairs = asked.select(*key, "kind", "size", F.col(own).alias("a"), F.element_at(F.array(*others), F.col("kind") + 1).alias("b"))
        larger = stash(peel_larger(pairs.repartition(partitions, *key, "kind"), [*key, "kind"], attempt), "peeled")
        solved.append(larger.where("open = 0").select(*key, "kind", "found"))
        rest = larger.where("open > 0").select(*key, "kind", "size")
        if not rest.limit(1).count():
            break
        asked = base.select(*key, *names).join(rest.withColumn("size", F.col("size") * 2), key)
    per = reduce(DataFrame.unionByName, solved).groupBy(*key).agg(
        *[F.first(F.when(F.col("kind") == i, F.col("found")), ignorenulls=True).alias(f"larger_{x}") for i, x in enumerate(others)])

    def side(x: str, c: int) -> Column:
        return F.transform(F.filter(F.coalesce(f"found_{x}", f"larger_{x}"), lambda p: p["c"] == c), lambda p: p["k"].cast("int"))

    return base.join(per, key, "left").select(*sets.columns, *[f"sketch_{x}" for x in names],
                                              *[col for x in others for col in (side(x, 1).alias(f"only_{own}_{x}"), side(x, -1).alias(f"only_{x}"))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the digests that the edit
    took away and brought (removed, added)."""
    made = compare(versions(docs), ["did", "h"], "own", ["edited", "next"])
    sizes = {x: F.size(x) for x in ("own", "edited", "next")}
    differ = {x: F.size(f"only_own_{x}") + F.size(f"only_{x}") for x in ("edited", "next")}
    return made.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("sketch_own")).alias("fingerprint"), written(F.col("sketch_edited")).alias("edited_fingerprint"),
        likeness(sizes["own"], sizes["edited"], differ["edited"]).alias("near_edited"), likeness(sizes["own"], sizes["next"], differ["next"]).alias("near_next"),
        F.sort_array("only_own_edited").alias("removed"), F.sort_array("only_edited").alias("added"))
