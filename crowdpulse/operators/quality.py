"""Data quality.

Checks return a small report DataFrame ``(check, passed, failed_rows, detail)``
computed in as few passes as possible; ``fail_if_any`` turns a report into an
exception (the reference swallowed failures, D9/D10).
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crowdpulse.sources.contracts import VARIANT_KINDS

REPORT_COLS = ("check", "passed", "failed_rows", "detail")


class QualityError(RuntimeError):
    pass


def _rows(*items) -> Column:
    """items: (name, passed Column, failed_rows Column, detail Column)."""
    return F.explode(F.array(*[F.struct(F.lit(n).alias("check"), p.alias("passed"),
                                        f.cast("long").alias("failed_rows"), d.cast("string").alias("detail"))
                               for n, p, f, d in items])).alias("r")


def _report(agg: DataFrame, *items) -> DataFrame:
    return agg.select(_rows(*items)).select("r.*")


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(cond.cast("long")), F.lit(0))


def _fail_count_check(df: DataFrame, name: str, failing: Column) -> DataFrame:
    agg = df.agg(_count_if(failing).alias("n"))
    return _report(agg, (name, F.col("n") == 0, F.col("n"), F.lit(None)))


def check_volume(df: DataFrame) -> DataFrame:
    """Table is not empty (DQ1)."""
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    return _report(agg, ("volume", F.col("n") > 0, F.lit(0), F.col("n")))


COMPLETENESS_KEYS = ("window_start", "marker_id", "region", "device", "cdn")


def _incomplete(keys=COMPLETENESS_KEYS) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond | (F.col("total_revenue_brl").isNotNull() & F.col("advertiser_name").isNull())


def check_completeness(gold: DataFrame, keys=COMPLETENESS_KEYS) -> DataFrame:
    """Keys not null; revenue implies an advertiser (DQ2)."""
    return _fail_count_check(gold, "completeness", _incomplete(keys))


def check_revenue(gold: DataFrame) -> DataFrame:
    """Revenue not negative (DQ3)."""
    return _fail_count_check(gold, "revenue_not_negative",
                             F.col("total_revenue_brl").isNotNull() & (F.col("total_revenue_brl") < 0))


def check_audience(gold: DataFrame) -> DataFrame:
    """CCV not negative (DQ4)."""
    return _fail_count_check(gold, "audience_not_negative", F.col("ccv") < 0)


def _freshness_aggs() -> list[Column]:
    commercial = F.col("total_revenue_brl").isNotNull()
    # latest commercial window and the smallest revenue on it, in one pass:
    # max over (window, -revenue) picks the latest window, then the most negative -revenue's opposite
    latest_comm = F.max(F.when(commercial, F.struct(F.col("window_start").alias("w"),
                                                    (-F.col("total_revenue_brl")).alias("neg_rev"))))
    return [F.max("window_start").alias("_latest"), latest_comm.alias("_comm")]


def _freshness_item(max_lag_s: int):
    lag = F.unix_timestamp("_latest") - F.unix_timestamp("_comm.w")
    min_rev = -F.col("_comm.neg_rev")
    no_comm = F.col("_comm").isNull()
    passed = no_comm | ((min_rev > 0) & (lag <= max_lag_s))
    detail = F.when(no_comm, F.lit("warning: no commercial rows")).otherwise(
        F.concat(F.lit("lag_s="), lag.cast("string"), F.lit(" min_revenue="), min_rev.cast("string")))
    return ("freshness", passed, F.when(passed, 0).otherwise(1), detail)


def check_freshness(gold: DataFrame, max_lag_s: int = 600) -> DataFrame:
    """Newest commercial window has revenue > 0 and lags the newest window by
    at most ``max_lag_s``; no commercial rows is only a warning (DQ5, A18)."""
    return _report(gold.agg(*_freshness_aggs()), _freshness_item(max_lag_s))


def check_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Non-null ``col`` within [lo, hi] (DQ7)."""
    return _fail_count_check(df, f"range:{col}", F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def check_ad_revenue(gold: DataFrame) -> DataFrame:
    """Rows with an advertiser earn something (DQ7)."""
    paid = F.col("advertiser_name").isNotNull()
    return _fail_count_check(gold, "ad_revenue_positive", paid & ~F.coalesce(F.col("total_revenue_brl") > 0, F.lit(False)))


def check_unique(df: DataFrame, keys) -> DataFrame:
    """No two rows share ``keys`` (DQ7); failed_rows counts rows in
    duplicated groups."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    agg = dup.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    return _report(agg, ("unique:" + ",".join(keys), F.col("n") == 0, F.col("n"), F.lit(None)))


def gold_quality_report(gold: DataFrame, max_lag_s: int = 600) -> DataFrame:
    """DQ1-DQ5 and the error-rate range in ONE aggregation pass over Gold
    (the reference ran up to eight separate actions)."""
    agg = gold.agg(
        F.count(F.lit(1)).alias("_n"),
        _count_if(_incomplete()).alias("_incomplete"),
        _count_if(F.col("total_revenue_brl").isNotNull() & (F.col("total_revenue_brl") < 0)).alias("_neg_rev"),
        _count_if(F.col("ccv") < 0).alias("_neg_ccv"),
        _count_if(F.col("error_rate").isNotNull() & ~F.col("error_rate").between(0, 1)).alias("_bad_rate"),
        *_freshness_aggs())
    return _report(
        agg,
        ("volume", F.col("_n") > 0, F.lit(0), F.col("_n")),
        ("completeness", F.col("_incomplete") == 0, F.col("_incomplete"), F.lit(None)),
        ("revenue_not_negative", F.col("_neg_rev") == 0, F.col("_neg_rev"), F.lit(None)),
        ("audience_not_negative", F.col("_neg_ccv") == 0, F.col("_neg_ccv"), F.lit(None)),
        ("range:error_rate", F.col("_bad_rate") == 0, F.col("_bad_rate"), F.lit(None)),
        _freshness_item(max_lag_s),
    )


def fail_if_any(report: DataFrame) -> None:
    """Raise with every failed check (T4). A report has one row per check, so it is small."""
    bad = report.where(~F.col("passed")).collect()
    if bad:
        raise QualityError("; ".join(f"{r['check']} failed ({r['failed_rows']} rows) {r['detail'] or ''}"
                                     for r in bad))


def key_rules(keys=COMPLETENESS_KEYS) -> dict[str, Column]:
    """The default rule of a keyed sink (DQ6): none of the Silver keys is null. A rule is a condition that no row may meet."""
    return {"silver_keys": reduce(or_, [F.col(k).isNull() for k in keys])}


def observed(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with its row count and the rows that break each rule counted on the way to whatever action runs on it."""
    seen = Observation()
    counts = [_count_if(bad).alias(name) for name, bad in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts), seen


def fail_if_observed(seen: Observation) -> int:
    """Rows of an observed DataFrame after its action; raises if a rule was broken."""
    got = seen.get
    broken = {k: v for k, v in got.items() if k != "_rows" and v}
    if broken:
        raise QualityError("; ".join(f"{k} failed ({v} rows)" for k, v in broken.items()))
    return got["_rows"] or 0


# ---- contracts (DQ8) -------------------------------------------------------

def _kind_ok(typ: Column, kind: str) -> Column:
    if kind == "object":
        return typ.startswith("OBJECT")
    return F.regexp_extract(typ, "^[A-Z]+", 0).isin(list(VARIANT_KINDS[kind]))


def _variant_type(path: str, kind: str) -> Column:
    """JSON type name at ``path`` of the parsed payload ``_v``: the variant
    type for leaves; for objects only OBJECT / VOID / OTHER, without building
    the object's full type string."""
    node = F.variant_get("_v", path, "variant")
    if kind != "object":
        return F.schema_of_variant(node)
    is_obj = F.try_variant_get("_v", path, "map<string,variant>").isNotNull()
    return (F.when(node.isNull(), F.lit(None).cast("string")).when(is_obj, F.lit("OBJECT"))
            .when(F.is_variant_null(node), F.lit("VOID")).otherwise(F.lit("OTHER")))


_PLAIN = r"(?:VOID|STRING|BOOLEAN|BIGINT|DOUBLE|VARIANT|DECIMAL\(\d+,\d+\))"


def _valid_type(contract, parent: str = "") -> str:
    """Regular expression of the types (as ``schema_of_variant`` writes them, keys sorted) of payloads that have just the
    contract's fields and break none of its rules. What doesn't match may be valid still."""
    fields = ""
    for path, kind, required, nullable in sorted(contract, key=lambda f: f[0].rsplit(".", 1)[-1]):
        if path.rpartition(".")[0] != parent:
            continue
        if kind == "object":
            typ = _valid_type(contract, path)
        elif kind == "array":
            typ = f"ARRAY<{_PLAIN}>"
        else:
            typ = "|".join(rf"{t}\(\d+,\d+\)" if t == "DECIMAL" else t for t in VARIANT_KINDS[kind])
        name = re.escape(path.rsplit(".", 1)[-1])
        fields += f"(?:{name}: (?:{typ}{'|VOID' if nullable else ''})(?:, |(?=>))){'' if required else '?'}"
    return f"OBJECT<{fields}>"


def validate_contract(raw: DataFrame, contract, value_col: str = "value", enums: dict | None = None) -> DataFrame:
    """Add ``violations`` (array<string>: ``malformed_json``,
    ``missing:<path>``, ``null:<path>``, ``type:<path>``, and ``enum:<path>``
    for a string that is none of ``enums[path]``) and ``valid`` to raw
    records (DQ8). The payload is parsed once into a VARIANT and each path's
    JSON type read from it, all JVM-side; of payloads whose whole type is a
    valid one (most), no path is looked up."""
    paths = [p for p, *_ in contract]
    tname = {p: f"_t{i}" for i, p in enumerate(paths)}
    staged = raw.withColumn("_v", F.try_parse_json(F.col(value_col).cast("string")))
    # The types come out of a one-row generator: filters on the result (e.g. the
    # DLQ split) then stop above it instead of inlining the parse per path.
    kinds = {p: k for p, k, *_ in contract}
    types = F.struct(_variant_type("$", "object").alias("_top"),
                     *[_variant_type(f"$.{p}", kinds[p]).alias(tname[p]) for p in paths])
    said = [F.try_variant_get("_v", f"$.{p}", "string").alias(f"_e{i}") for i, p in enumerate(enums or {})]
    staged = staged.select("*", F.coalesce(F.schema_of_variant("_v").rlike(f"^{_valid_type(contract)}$"), F.lit(False)).alias("_ok"), *said)
    staged = staged.select("*", F.inline(F.array(F.when(~F.col("_ok"), types))))
    is_obj = F.col("_v").isNotNull() & F.coalesce(F.col("_top").startswith("OBJECT"), F.lit(False))
    items = [F.when(~is_obj, F.lit("malformed_json"))]
    for path, kind, required, nullable in contract:
        typ = F.col(tname[path])
        guard = is_obj
        if "." in path:  # only judge a child when its parent object is there
            guard = guard & F.coalesce(F.col(tname[path.rsplit(".", 1)[0]]).startswith("OBJECT"), F.lit(False))
        if required:
            items.append(F.when(guard & typ.isNull(), F.lit(f"missing:{path}")))
        if not nullable:
            items.append(F.when(guard & (typ == "VOID"), F.lit(f"null:{path}")))
        items.append(F.when(guard & typ.isNotNull() & (typ != "VOID") & ~_kind_ok(typ, kind), F.lit(f"type:{path}")))
    for i, (path, values) in enumerate((enums or {}).items()):
        items.append(F.when(is_obj & (F.col(tname[path]) == "STRING") & ~F.col(f"_e{i}").isin(list(values)), F.lit(f"enum:{path}")))
    # of an ``_ok`` payload only enums are open
    allowed = [F.when(~F.col(f"_e{i}").isin(list(values)), F.lit(f"enum:{path}")) for i, (path, values) in enumerate((enums or {}).items())]
    out = staged.withColumn("violations", F.array_compact(F.when(F.col("_ok"), F.array(*allowed).cast("array<string>")).otherwise(F.array(*items))))
    return out.drop("_v", "_ok", "_top", *tname.values(), *[f"_e{i}" for i in range(len(enums or {}))]).withColumn("valid", F.size("violations") == 0)


def split_valid_dlq(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead-letter rows with a ``reason``) (SK9)."""
    valid = validated.where(F.col("valid")).drop("violations", "valid")
    dlq = validated.where(~F.col("valid")).withColumn("reason", F.concat_ws(";", "violations")).drop("valid")
    return valid, dlq


def schema_drift(raw: DataFrame, known_keys, value_col: str = "value") -> DataFrame:
    """Inventory of top-level JSON keys with counts; ``known`` flags keys of
    the contract (F18)."""
    keys = raw.select(F.explode(F.json_object_keys(F.col(value_col).cast("string"))).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "known", F.col("key").isin(list(known_keys)))


def nested_drift(raw: DataFrame, known_paths, value_col: str = "value") -> DataFrame:
    """Every path of the payloads with its JSON types (F18): path (``device.type``, ``items[]`` for array elements), type,
    rows that have it (an element counts each), share of all readable payloads, and whether the contract knows the path.

    Payloads are parsed into variants, and each level of objects and arrays is exploded until nothing nested is left, so the
    number of jobs is the depth of the deepest payload. A malformed payload has no paths; the top level has none itself."""
    spark = raw.sparkSession
    top = raw.select(F.try_parse_json(F.col(value_col).cast("string")).alias("v")).where(F.col("v").isNotNull())
    payloads = top.count()
    rows, levels = top.select(F.lit("").alias("path"), "v", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0).alias("type")), []
    while True:
        nested = rows.where(F.col("type").isin("OBJECT", "ARRAY"))
        if nested.limit(1).count() == 0:
            break
        inner = nested.select("path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        dot = F.when((F.col("path") == "") | F.col("key").isNull(), F.lit("")).otherwise(F.lit("."))
        rows = inner.select(F.concat("path", dot, F.coalesce("key", F.lit("[]"))).alias("path"), F.col("value").alias("v"),
                            F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0).alias("type"))
        levels.append(rows.groupBy("path", "type").agg(F.count(F.lit(1)).alias("rows")))
    none = spark.createDataFrame([], "path string, type string, rows long")
    every = reduce(DataFrame.unionByName, levels, none)
    return every.select("path", "type", "rows", (F.col("rows").cast("double") / payloads).alias("share"), F.col("path").isin(list(known_paths)).alias("known"))


def injection_audit(events: DataFrame) -> DataFrame:
    """Rows, event_ids seen more than once, v2 rows."""
    per_id = events.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("network_type").isNotNull().cast("long")).alias("v2"))
    return per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                      _count_if(F.col("n") > 1).alias("duplicated_ids"),
                      F.coalesce(F.sum("v2"), F.lit(0)).alias("v2_rows"))
