"""The registered queries of the training-text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import (bytebpe, crosspoly, divergence, forblocks, langmix, meansearch, merkle, minmax, mixing, punlearn,
                          rollups, templates, warc)
from leadloom.llm.common import WORD, read_table, word_count
from leadloom.session import cut_lineage, fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return register


SQL_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query("op1_mixing", rf"""
WITH d AS (SELECT doc_id, source, CAST({SQL_SIZE} AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
r AS (SELECT *, sum(source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS size_before,
      sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from, sum(source_size) OVER () AS all_size FROM w),
l AS (SELECT *, (all_size - 3.0::DOUBLE * coalesce(size_before, 0)) / weight_from AS level FROM r),
f AS (SELECT min(3.0::DOUBLE * source_size / weight) AS ratio FROM l WHERE level * weight <= 3.0::DOUBLE * source_size),
g AS (SELECT min_by(level, 3.0::DOUBLE * source_size / weight) AS level FROM l
      WHERE level * weight <= 3.0::DOUBLE * source_size),
t AS (SELECT source, source_size, CASE WHEN l.level * weight > 3.0::DOUBLE * source_size THEN 3.0::DOUBLE * source_size
        ELSE g.level * weight END AS target FROM l, g),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
      coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(greatest(least(goal - before, size), 0)
  + greatest(least(goal - source_size - before, size), 0) + greatest(least(goal - 2 * source_size - before, size), 0)
  AS BIGINT) AS taken FROM p
""")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training stream is written in order of position; the words taken are those that stand in it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    _stream, rows = mixing.mix_counted(docs, [5.0, 2.0, 1.0], max_repeats=3.0)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_language_mixture")
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    aside = langmix.held_out(F.col("doc_id"), 3, 1)
    model = langmix.fit(docs.filter(~aside))
    rows = langmix.predict(docs.select("doc_id", aside.alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")


@query("op3_warc", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
      min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_FROM} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_FROM} AND page_id > first THEN first END AS refers_to FROM f
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_records(read_table(spark, sf_dir, "pages"), path)
    rows = warc.read_records(spark, path)
    return rows.select(warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       warc.page_number(F.col("refers_to")).alias("refers_to"))


def _sql_tree(text: str) -> str:
    leaf = f"list_transform(regexp_extract_all(p, '{merkle.PIECE}'), lambda x: substr(sha256(x), 1, 16))"
    lines = f"list_transform(string_split({text}, chr(10)), lambda p: array_to_string({leaf}, '.'))"
    ends = f"CASE WHEN substr(sha256(q), 1, 1) IN {tuple(merkle.ENDS)} THEN ';' ELSE ',' END"
    return f"array_to_string(list_transform({lines}, lambda q: q || {ends}), '')"


def _sql_root(tree: str) -> str:
    section = "sha256(array_to_string(list_transform(string_split(s, ','), lambda p: sha256(p)), ''))"
    return f"sha256(array_to_string(list_transform(string_split({tree}, ';'), lambda s: {section}), ''))"


def _sql_likeness(a: str, b: str) -> str:
    x, y = (f"list_distinct(string_split_regex({t}, '[.,;]'))" for t in (a, b))
    return (f"CASE WHEN {a}_root = {b}_root THEN 1.0::DOUBLE ELSE len(list_intersect({x}, {y}))::DOUBLE"
            f" / greatest(len({x}), len({y})) END")


@query("op4_merkle", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, length(text) AS n_chars, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id))
      AS next_text FROM d),
e AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(next_text, 1, n_chars // 4) AS edited FROM n),
t AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_sql_tree("text")} AS a, {_sql_tree("edited")} AS b,
      {_sql_tree("next_text")} AS c FROM e),
r AS (SELECT *, {_sql_root("a")} AS a_root, {_sql_root("b")} AS b_root, {_sql_root("c")} AS c_root FROM t)
SELECT doc_id, n_chars, edited_sha256, a_root || ':' || a AS fingerprint, b_root || ':' || b AS edited_fingerprint,
  {_sql_likeness("a", "b")} AS near_edited, {_sql_likeness("a", "c")} AS near_next FROM r
""")
def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(read_table(spark, sf_dir, "documents"))


@query("op5_line_templates")
def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = templates.drop_recurring(read_table(spark, sf_dir, "documents").select("doc_id", "text"), dropped="n_dropped")
    return rows.select("doc_id", "n_dropped", F.char_length("text").cast("long").alias("n_chars_left"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op6_cross_polytope")
def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspoly.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query("op7_quality_pu")
def op7_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rows = punlearn.quality(docs, labels, lambda doc_id: ~langmix.held_out(doc_id, 4, 2))
    return rows.select("doc_id", (~F.col("learned")).alias("held_out"), "score", "predicted")


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bytebpe.encode(docs, path, pattern).drop("text")
    both = bytebpe.decode(ids, path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_minmax_dedup")
def op9_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(read_table(spark, sf_dir, "documents"), k=2, percent=80)


#: An address as the redaction batch of op10 takes it.
MAIL = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+"


@query("op10_token_rollup", rf"""
WITH d AS (SELECT doc_id, source, lang, text, regexp_replace(text, '{MAIL}', '', 'g') AS clean FROM documents),
n AS (SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words,
      CAST(len(regexp_extract_all(coalesce(clean, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS clean_words,
      CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes, CAST(strlen(coalesce(clean, '')) AS BIGINT) AS clean_bytes,
      doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM d),
v AS (SELECT source, lang, 'words-1' AS tokenizer, clean_words AS tokens FROM n WHERE NOT toxic
      UNION ALL SELECT source, lang, 'bytes-1', clean_bytes FROM n WHERE NOT toxic)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM v GROUP BY ALL
""")
def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents, revise those that hold addresses, delete the toxic ones; the second batch is sent twice.

    The counts of both tokenizers, before and after redaction, are taken in one pass over the texts; batches read those.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    clean = F.regexp_replace("text", MAIL, "")
    counts = cut_lineage(docs.select(
        "doc_id", "source", "lang", (F.col("text") != clean).alias("redacted"),
        *[F.struct(word_count(text).alias("words-1"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes-1"))
          .alias(name) for text, name in ((F.col("text"), "raw"), (clean, "clean"))]))
    toxic = read_table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()

    def changes(rows: DataFrame, op: str, old: str | None, new: str | None) -> DataFrame:
        def side(text: str | None, tokenizer: str):
            tokens = F.col(f"{text}.`{tokenizer}`") if text else F.lit(None).cast("long")
            full = F.struct("source", "lang", F.lit(tokenizer).alias("tokenizer"), tokens.alias("tokens"))
            return full if text else F.when(F.lit(False), full)

        pairs = [F.struct(side(old, t).alias("old"), side(new, t).alias("new")) for t in ("words-1", "bytes-1")]
        return rows.select(F.lit(op).alias("op"), F.explode(F.array(*pairs)).alias("c")).select("op", "c.*")

    rollup = rollups.Rollup(spark, fresh_path(spark, "rollup"))
    rollup.commit("insert", changes(counts, "insert", None, "raw"))
    redacted = changes(counts.filter("redacted"), "revise", "raw", "clean")
    rollup.commit("redact", redacted)
    rollup.commit("redact", redacted)
    rollup.commit("toxic", changes(counts.join(toxic, "doc_id", "left_semi"), "delete", "clean", None))
    return rollup.totals()


def _sql_rounds(rounds: int) -> str:
    """Tables c1, c2, ... of centroids after each round, from x (vectors by component) and c0; ``own`` is the last assignment."""
    nearest = """SELECT rid, cluster, distance FROM (SELECT x.rid, c.cluster, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS distance
      FROM x JOIN c{0} c ON x.i = c.i GROUP BY x.rid, c.cluster)
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1"""
    parts = []
    for r in range(rounds):
        parts.append(f"""a{r} AS MATERIALIZED ({nearest.format(r)}),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n
  FROM a{r} JOIN x USING (rid) GROUP BY cluster, i)) m ON c.cluster = m.cluster AND c.i = m.i)""")
    return ",\n".join([*parts, f"own AS MATERIALIZED ({nearest.format(rounds)})"])


@query("op11_centroids", f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
w AS MATERIALIZED (SELECT rid, vec_id, list_transform(embedding, lambda y: CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT)) AS v FROM v),
x AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM w),
s AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS cluster FROM w),
c0 AS MATERIALIZED (SELECT CAST(cluster AS INTEGER) AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM s WHERE cluster < 16),
{_sql_rounds(3)},
h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM own JOIN w USING (rid) JOIN h USING (cluster)
""")
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meansearch.cluster(read_table(spark, sf_dir, "embeddings"))


@query("op12_token_blocks")
def op12_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ids")
    forblocks.write_ids(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    rows = forblocks.read_ids(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op13_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS MATERIALIZED (SELECT n, lang, source, unnest(terms) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT n) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS c FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
t AS (SELECT lang, source, sum(c) AS total FROM c GROUP BY ALL),
f AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
  1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (coalesce(t.total, 0) + v.v) AS p
  FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang LEFT JOIN t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.c) + 1)) // (any_value(s.total) + any_value(v.v)) AS q
  FROM c JOIN v ON c.lang = v.lang JOIN (SELECT lang, sum(total) AS total FROM t GROUP BY lang) s ON c.lang = s.lang
  GROUP BY c.lang, c.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
best AS (SELECT f.lang, f.source, f.term AS item, ((p - q) * (p - q)) // q AS value FROM f JOIN l ON f.lang = l.lang AND f.term = l.term
  WHERE f.c > 0 AND p > q),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a
  JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM best)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 200
""")
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))
