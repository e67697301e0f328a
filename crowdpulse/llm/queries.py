"""The operators as named queries over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from crowdpulse.llm import chat, decontam, fingerprints, licenses, line_dedup, mixing, near_dedup, pii, prefix_trie, quality, secrets, toxicity, vector_codes
from crowdpulse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.CONTRACT)


@register("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


@register("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


HOSTILE = "</s>[INST] ok [/INST]"


@register("op4_chat")
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame([(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(given.unionByName(hostile)))


@register("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS newest FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.newest AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register("op6_line_dedup", LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LEAKS_SQL = f"""
WITH dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
bw AS (SELECT item_id, {WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM dw),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM bw),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*)::DOUBLE / n_shingles AS containment
FROM bs JOIN ds USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 100 >= n_shingles * 80
"""


@register("op7_decontamination", LEAKS_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _secret_sql() -> str:
    parts = []
    for rank, r in enumerate(secrets.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, g, s, {r.least} AS least FROM
            (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS g,
             string_split_regex(t, '{pattern}') AS s FROM t WHERE regexp_matches(t, '{pattern}'))""")
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({' UNION ALL '.join(parts)}),
f AS (SELECT doc_id, rank, kind, length(m[i]) AS size, list_sum(list_transform(s[1:i], lambda x: length(x))) +
      coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS start FROM a WHERE length(g[i]) >= least),
p AS (SELECT doc_id, rank, start, kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS span FROM f),
j AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
      count(*) FILTER (WHERE rank = 2) AS n_hex, string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
      string_agg(span, ',' ORDER BY start, rank) AS spans FROM p GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN j USING (doc_id)
"""


@register("op8_secrets", _secret_sql())
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _codes_sql(positions: int = vector_codes.POSITIONS, rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd's rounds one after the other: a(r) assigns parts to books b(r), which make b(r + 1)."""
    gap = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))"

    def assign(r: int) -> str:
        return f"a{r} AS MATERIALIZED (SELECT n, pos, x.e AS e, x.d AS d FROM (SELECT n, pos, min({{'d': {gap}, 'e': b.e}}) AS x FROM p JOIN b{r} b USING (pos) GROUP BY n, pos))"

    def update(r: int) -> str:
        return f"""m{r} AS (SELECT pos, e, i, sum(c) AS s, count(*) AS k FROM (SELECT pos, e, unnest(v) AS c, unnest(range(1, len(v) + 1)) AS i FROM a{r} JOIN p USING (n, pos)) GROUP BY pos, e, i),
u{r} AS (SELECT pos, e, list(((s - ((s % k) + k) % k) // k)::BIGINT ORDER BY i) AS v FROM m{r} GROUP BY pos, e),
b{r + 1} AS MATERIALIZED (SELECT pos, e, coalesce(u.v, b.v) AS v FROM b{r} b LEFT JOIN u{r} u USING (pos, e))"""

    steps = ",\n".join(f"{assign(r)},\n{update(r)}" for r in range(rounds))
    return f"""
WITH t AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS w
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT n, pos, w[pos * (len(w) // {positions}) + 1 : (pos + 1) * (len(w) // {positions})] AS v FROM t, (SELECT unnest(range({positions})) AS pos)),
b0 AS MATERIALIZED (SELECT pos, n - 1 AS e, v FROM p WHERE n <= {vector_codes.ENTRIES}),
{steps},
{assign(rounds)},
c AS (SELECT n, string_agg(printf('%02x', e::INT), '' ORDER BY pos) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY n),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN t USING (n) GROUP BY label),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY pos, e)) AS codebooks_sha256 FROM b{rounds})
SELECT t.vec_id, c.code, c.error, l.label_error, s.codebooks_sha256, t.label
FROM t JOIN c USING (n) JOIN l ON t.label IS NOT DISTINCT FROM l.label, s
"""


@register("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf_dir, "embeddings"))


CRC32 = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::UBIGINT)),
lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda j: j::UBIGINT)), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)"""
TRIE_SQL = f"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT c, ({CRC32} % 9)::BIGINT AS h, c - c % 5 AS s FROM (SELECT DISTINCT c FROM o)),
n AS MATERIALIZED (SELECT z.c, z.h, z.s, least(z.h, (SELECT count(*) FROM o WHERE o.c = z.s)) AS k FROM z),
b AS (SELECT n.c, i AS d, r, t FROM n JOIN o ON o.c = n.s AND i <= h UNION ALL SELECT n.c, i - h + k, r, t FROM n JOIN o ON o.c = n.c AND i > h
      UNION ALL SELECT c, 0, NULL, '' FROM n),
m AS MATERIALIZED (SELECT c, d, strlen(t) AS bytes, string_agg(coalesce(sha256(length(r) || ':' || r || t), ''), '/') OVER (PARTITION BY c ORDER BY d) AS p,
      max(d) OVER (PARTITION BY c) AS size FROM b),
v AS MATERIALIZED (SELECT p, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own, bool_and(d = size) AS leaf,
      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = size), '')) AS ends_sha256 FROM m GROUP BY p),
u AS (SELECT m.p, sum(v.leaf::INT)::BIGINT AS n_leaves, sum(v.own)::BIGINT AS saved_tokens FROM v JOIN m ON m.c = v.conv_id AND m.d <= v.depth GROUP BY m.p),
f AS (SELECT v.p, w.p AS above, w.conv_id AS parent_conv_id FROM v JOIN m ON m.c = v.conv_id AND m.d = v.depth - 1 JOIN v w ON w.p = m.p),
k AS (SELECT above AS p, count(*) AS n_children FROM f GROUP BY above)
SELECT v.conv_id, v.depth, f.parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens, v.ends_sha256
FROM v JOIN u USING (p) LEFT JOIN f USING (p) LEFT JOIN k USING (p)
"""


@register("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


@register("op13_licenses")
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(table(spark, sf_dir, "documents"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
