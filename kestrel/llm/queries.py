"""The registered queries of this package: each applies one operator to its whole
table and derives the result columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import held_out, table, tokenizer_paths
from kestrel.llm.digest_index import DigestIndex, ingested
from kestrel.llm.divergence_audit import Audit
from kestrel.llm.external_shuffle import shuffled_shards, text_bytes
from kestrel.llm.fill_in_middle import fill_in_middle, restored
from kestrel.llm.language_id import identify, learn_profiles
from kestrel.llm.mixing import mix
from kestrel.llm.near_dedup import near_duplicates
from kestrel.llm.packing import pack
from kestrel.llm.phrase_dedup import remove_repeats
from kestrel.llm.quality_rules import quality_verdicts
from kestrel.llm.secret_scan import counted, listed, scan
from kestrel.llm.toxicity import fit, score
from kestrel.llm.vector_search import nearest
from kestrel.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), window=50, keep_text=False)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return found.select("doc_id", *[counted(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))


@query
def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept", "beyond")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = fit(table(spark, sf_dir, "labels").where(~held_out()), docs)
    return score(docs, network).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('8:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS lim,
         CASE (row_number() OVER (ORDER BY (source IS NULL), source COLLATE C) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY lim / weight, source) AS k FROM s),
p AS (
  SELECT *, 1.5 * (SELECT sum(source_size) FROM s) AS budget,
         coalesce(sum(lim) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM r),
v AS (SELECT arg_min((budget - used) / open, k) FILTER (WHERE lim / weight > (budget - used) / open) AS level FROM p),
t AS (
  SELECT source, source_size, CAST(least(lim, coalesce((SELECT level FROM v), 1e300) * weight) AS DOUBLE) AS target FROM s),
w AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
x AS (
  SELECT d.doc_id, d.size, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, h) AS own, h, d.source
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
y AS (SELECT *, min(CASE WHEN upto >= extra THEN h END) OVER (PARTITION BY source) AS last FROM x)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN h < last OR (h = last AND (extra - upto + own) * 2 >= own) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM y
"""


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shuffled_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return rows.select("doc_id", text_bytes("text").alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), **tokenizer_paths())


@query
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = Audit(table(spark, sf_dir, "documents"))
    parts = [rows.withColumn("part", F.lit(part)) for part, rows in (("pair", audit.pair_divergence()), ("term", audit.term_divergence()))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


ORACLES["op11_divergence_audit"] = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
w AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
c AS (SELECT lang, source, r, term, count(*) AS n FROM w GROUP BY ALL),
k AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY lang, term HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, term, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY ALL),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n, k.n AS lang_n
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total, sum(lang_n)::HUGEINT AS lang_total, count(*)::HUGEINT AS v FROM f GROUP BY ALL),
p AS (
  SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000::HUGEINT * (f.n + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (f.lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM f JOIN t ON t.lang = f.lang AND t.source = f.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sums.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return rows.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                       sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
x AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM x),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = DigestIndex.create(spark, scratch_path(spark, "digest-index"), dict(docs.dtypes)["doc_id"], docs.count())
    return ingested(docs, index, batches=4).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op13_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""
