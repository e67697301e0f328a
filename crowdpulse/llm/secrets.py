"""Secret scans over content-addressed versions with an incremental ledger, in SQL functions only.

Every historical version of a file is a blob, named by the SHA-256 of its text. The ledger holds two tables: which
(blob, rule version) pairs were scanned, and what they found. A scan takes all versions' names, keeps one path per
blob, asks the ledger which rule versions each blob still lacks, reads and scans only those, appends, and joins the
findings back to every path that holds the blob. Findings are appended before the pairs are marked as scanned, so
a run that dies in between is repeated, and readers drop the repeated findings.

Positions come from the text's pieces between matches: their lengths and the matches' add up to each start.

Defined cases: null text is empty and has no findings; a null path id is a path of its own; repeated rows each get the
blob's findings; an empty table gives an empty result and leaves the ledger as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm.common import fold_docs
from crowdpulse.session import checkpoint_root


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are tried from left to right without overlap; those whose ``group`` is shorter than
    ``least`` fail (and are not retried)."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# The base rules and their order, then further credential formats. A maximal run of one class that is too
# short fails as a whole, so there the length can stand in the pattern.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
FURTHER = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + FURTHER

#: Matches of a text that are added up in one growing array.
RUN = 256

SCANNED = "blob string, rule string"
FINDINGS = "blob string, rule string, kind string, start int, stop int"


@dataclass(frozen=True)
class Ledger:
    """Two append-only tables in a shared folder."""
    folder: str

    @staticmethod
    def create(spark: SparkSession, folder: str) -> Ledger:
        ledger = Ledger(folder.rstrip("/"))
        for name, ddl in (("scanned", SCANNED), ("findings", FINDINGS)):
            spark.createDataFrame([], ddl).write.mode("append").parquet(f"{ledger.folder}/{name}")
        return ledger

    def scanned(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCANNED).parquet(f"{self.folder}/scanned")

    def findings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FINDINGS).parquet(f"{self.folder}/findings")


def match_spans(text: Column, rule: Rule) -> Column:
    """array<struct<rule, kind, start, stop>> of the rule's matches, in code points; only texts with a match are split."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    cells = F.zip_with(F.slice(F.split(text, rule.pattern, -1), 1, F.size(whole)), F.arrays_zip(whole.alias("w"), tested.alias("t")),
                       lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m["w"]).alias("size"), F.length(m["t"]).alias("tested")))
    none = F.array().cast("array<struct<rule:string,kind:string,start:int,stop:int>>")

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        span = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), start.alias("start"), (start + m["size"]).alias("stop"))
        found = F.when(m["tested"] >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((start + m["size"]).alias("at"), found.alias("found"))

    # an array that grows is copied at each match, so matches are taken in runs, and only the runs' arrays are put together
    def run(state: Column, own: Column) -> Column:
        done = F.aggregate(own, F.struct(state["at"].alias("at"), none.alias("found")), step)
        return F.element_at(F.transform(F.array(done), lambda d: F.struct(d["at"].alias("at"), F.concat(state["runs"], F.array(d["found"])).alias("runs"))), 1)

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<rule:string,kind:string,start:int,stop:int>>>").alias("runs"))

    def spans(own: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / RUN).cast("int")), lambda i: F.slice(own, i * RUN + 1, RUN))
        return F.aggregate(runs, begin, run, lambda state: F.flatten(state["runs"]))

    return F.when(text.rlike(rule.pattern), F.element_at(F.transform(F.array(cells), spans), 1)).otherwise(none)


def scan_texts(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of (blob, text, todo): each blob by the rules named in ``todo``."""
    none = F.array().cast("array<struct<rule:string,kind:string,start:int,stop:int>>")
    each = [F.when(F.array_contains("todo", r.name), match_spans(F.col("text"), r)).otherwise(none) for r in rules]
    found = texts.select("blob", F.concat(*each).alias("found")).where(F.size("found") > 0)
    return found.select("blob", F.inline("found")).select("blob", "rule", "kind", "start", "stop")


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions`` (path, text); returns (path, blob) of every version."""
    spark = versions.sparkSession
    named = versions.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    # one path stands for the blob; a null path is told apart from every other
    key = F.struct(F.col("path").isNull().alias("none"), F.col("path").cast("string").alias("path"))
    one = named.groupBy("blob").agg(F.min(key).alias("key"))
    done = ledger.scanned(spark).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    missing = F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("done", F.array().cast("array<string>")))
    todo = one.join(done, "blob", "left").withColumn("todo", missing).where(F.size("todo") > 0).select("blob", "key", "todo")
    batch = f"{ledger.folder}/todo/{uuid.uuid4().hex}"
    todo.write.parquet(batch)
    todo = spark.read.schema(todo.schema).parquet(batch)
    pick = todo.select("blob", F.col("key.none").alias("none"), F.coalesce("key.path", F.lit("")).alias("p"), "todo")
    texts = (named.select("text", "blob", F.col("path").isNull().alias("none"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("p"))
             .join(pick.hint("shuffle_hash"), ["blob", "none", "p"]).select("blob", "text", "todo"))
    scan_texts(texts, rules).write.mode("append").parquet(f"{ledger.folder}/findings")
    todo.select("blob", F.explode("todo").alias("rule")).write.mode("append").parquet(f"{ledger.folder}/scanned")
    return named.select("path", "blob")


def findings_by_path(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob and its findings as a sorted array<struct<start, rank, stop, kind>>."""
    rank = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))]), F.col("rule"))
    current = ledger.findings(paths.sparkSession).where(F.col("rule").isin([r.name for r in rules]))
    per_blob = (current.distinct().withColumn("rank", rank).groupBy("blob")
                .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "stop", "kind"))).alias("found")))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    return paths.join(per_blob, "blob", "left").select("path", "blob", F.coalesce("found", none).alias("found"))


def joined_spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(docs: DataFrame, ledger_folder: str | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, blob. Without a folder the ledger begins empty."""
    spark = docs.sparkSession
    ledger = Ledger.create(spark, ledger_folder or f"{checkpoint_root(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}")
    paths = scan(fold_docs(docs).withColumnRenamed("doc_id", "path"), ledger)
    found = findings_by_path(paths, ledger)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))

    def count_of(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    counts = [count_of(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"),
                        joined_spans(F.col("found")).alias("spans"))
