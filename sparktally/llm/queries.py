"""The operators of this subpackage as named queries over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparktally.llm import (align, anchors, decontaminate, digest, hilbert, html_cut, line_runs, mixing, multi_index, pieces,
                            simhash_tree, toxicity, whiten)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_mix_sources(spark, folder):
    mixed = mixing.copies_of(_documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLE["op1_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS tie
  FROM documents),
sources AS (
  SELECT key, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY key)) - 1) % 3 + 1]::BIGINT AS weight
  FROM docs GROUP BY key),
levels AS (
  SELECT key, source_size, weight,
         ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER o, 0))::DOUBLE
         / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER o, 0)) AS level
  FROM sources
  WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT key, source_size,
         CASE WHEN level * weight >= 3 * source_size THEN (3 * source_size)::DOUBLE
              ELSE weight * (SELECT arg_min(level, {'a': (3 * source_size)::DOUBLE / weight, 'b': key})
                             FROM levels WHERE NOT level * weight >= 3 * source_size) END AS target
  FROM levels),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY key ORDER BY size, tie, doc_id))::DOUBLE AS place,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM docs JOIN targets USING (key)),
draws AS (
  SELECT key, draw,
         ('0x' || substr(md5('17:' || draw || ':' || key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS shift
  FROM targets CROSS JOIN range(16) t(draw)),
drawn AS (
  SELECT p.*, draw, least(floor(place * rate + shift) - floor((place - 1) * rate + shift), ceil(rate))::BIGINT AS copies
  FROM placed p JOIN draws USING (key)),
nearest AS (
  SELECT key, arg_min(draw, {'a': abs(words - target), 'b': draw}) AS draw
  FROM (SELECT key, draw, any_value(target) AS target, sum(copies * size) AS words FROM drawn GROUP BY key, draw)
  GROUP BY key)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM drawn JOIN nearest USING (key, draw)
"""


@query
def op2_multi_index_neighbours(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    return multi_index.nearest(table, F.col("vec_id") % 50 == 0, k=5)


@query
def op3_shard_hilbert(spark, folder):
    sharded = hilbert.shard_by_hilbert(_documents(spark, folder), shards=24)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op4_dedup_lines(spark, folder):
    kept = line_runs.dedup_lines(_documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op4_dedup_lines"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN owners o USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op5_main_text(spark, folder):
    return html_cut.extract(spark.read.parquet(f"{folder}/pages.parquet"))


@query
def op6_sentencepiece_encode(spark, folder):
    return pieces.encode(_documents(spark, folder), check=True)


@query
def op7_toxicity(spark, folder):
    docs = _documents(spark, folder)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.score(docs, lexicon).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "hits")


@query
def op8_quartile_digest(spark, folder):
    return digest.with_next(_documents(spark, folder))


@query
def op9_personal_data(spark, folder):
    found = anchors.find_personal_data(_documents(spark, folder))
    spans = F.col("spans")
    return found.select(
        "doc_id", *[anchors.count_kind(spans, k).alias(f"n_{k}") for k in anchors.BASE],
        F.sha2(anchors.spans_text(anchors.base_spans(spans)), 256).alias("base_sha256"),
        anchors.spans_text(spans).alias("spans"))


@query
def op10_simhash_components(spark, folder):
    found = simhash_tree.near_duplicates(_documents(spark, folder), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_whiten(spark, folder):
    found = whiten.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_decontaminate(spark, folder):
    found = decontaminate.contamination(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op12_decontaminate"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
tests AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
grams AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM tests, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
widths AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM docs CROSS JOIN widths, unnest(range(1, len(w) - n + 2)) t(i)),
hits AS (SELECT r, i, n, item FROM windows JOIN grams USING (n, gram)),
hit_words AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM hits, unnest(range(i, i + n)) t(p) GROUP BY r),
hit_items AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


@query
def op13_align_tokenizers(spark, folder):
    return align.align(_documents(spark, folder))
