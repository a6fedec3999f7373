"""The corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import (
    bagminhash,
    block_dedup,
    decontamination,
    fingerprints,
    packing,
    projection_forest,
    quality,
    source_audit,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from starling.llm.common import is_held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Queries that SQL can express as well.
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.url_filter(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, folder, "documents"), model, budget=4096)


def packed(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its place; ids come as a checksum."""
    items = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)
    items = items.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    placed = packing.pack(items, capacity=2048)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(toxicity.sample_of(docs, labels, folds=3, held_out=1))
    scored = toxicity.rejected(toxicity.toxicity(docs, model), threshold=0.7)
    held_out = is_held_out(F.col("doc_id"), 3, 1)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "sentences")


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.quality(docs, quality.fit(quality.sample_of(docs, labels, folds=5, held_out=0)))
    held_out = is_held_out(F.col("doc_id"), 5, 0)
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """class_id is the smallest doc_id of the class; kept marks the one document of it that stays."""
    found = bagminhash.near_duplicates(table(spark, folder, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("copy") == F.col("class_copy"))
    return found.select("doc_id", "class_id", kept.alias("kept"))


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_dedup.without_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "longest_repeat")


# The same by comparing all windows.
ORACLE["op5_block_dedup"] = r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
  h AS (SELECT r, generate_subscripts(hs, 1) AS i, unnest(hs) AS h FROM (SELECT r, list_transform(range(1, len(w) - 33),
    lambda i: md5(array_to_string(w[i:i + 34], ' '))) AS hs FROM d WHERE len(w) >= 35) AS x),
  twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM h) AS x WHERE n > 1),
  gone AS (SELECT DISTINCT r, i + k AS p FROM (SELECT r, i, unnest(range(0, 35)) AS k FROM twice) AS x),
  kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM (SELECT r, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d) AS x ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""


@query
def op5_block_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = block_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


# All groups by all kept terms.
ORACLE["op11_source_audit"] = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
  t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
  langs AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS words FROM kept GROUP BY lang),
  n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
  g AS (SELECT lang, source, coalesce(own, 0) AS own FROM (SELECT DISTINCT lang, source FROM d) AS x
    LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS own FROM n GROUP BY lang, source) AS y USING (lang, source)),
  p AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, 1 + 1000000000 * (coalesce(n.n, 0) + 2) // (own + 2 * v) AS p,
      1 + 1000000000 * (total + 2) // (words + 2 * v) AS q
    FROM g JOIN kept AS k USING (lang) JOIN langs USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
  f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
    FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g AS a
    JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) AS x)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10"""


@query
def op11_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(table(spark, folder, "documents"))


@query
def op12_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return projection_forest.neighbours(table(spark, folder, "embeddings"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain rounds: every part is compared with every entry."""
    sql = [
        f"""WITH whole AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  parts AS MATERIALIZED (SELECT r, part, w[part * len(w) // {parts} + 1:(part + 1) * len(w) // {parts}] AS v
    FROM whole, (SELECT unnest(range({parts})) AS part) AS x),
  book0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, r) - 1 AS entry, v
    FROM parts JOIN whole USING (r) QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id, r) <= {entries})"""
    ]
    for i in range(rounds + 1):
        sql.append(f"""near{i} AS MATERIALIZED (SELECT r, part, min(struct_pack(d, entry)) AS best FROM (SELECT r, p.part, entry,
      list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, b.v) + list_dot_product(b.v, b.v) AS d
      FROM parts AS p JOIN book{i} AS b USING (part)) AS x GROUP BY r, part)""")
        if i < rounds:
            sql.append(f"""book{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{i} AS b LEFT JOIN (
      SELECT part, entry, list(mean ORDER BY place) AS v FROM (SELECT part, entry, place, floor(sum(x) / count(*)) AS mean FROM (
        SELECT part, best.entry AS entry, generate_subscripts(v, 1) AS place, unnest(v) AS x FROM parts JOIN near{i} USING (r, part)) AS y
        GROUP BY part, entry, place) AS z GROUP BY part, entry) AS m USING (part, entry))""")
    sql.append(f"""flat AS (SELECT part, entry, generate_subscripts(v, 1) AS place, unnest(v)::BIGINT AS x FROM book{rounds}),
  sha AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM flat),
  coded AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
    FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN coded USING (r), sha""")
    return ",\n  ".join(sql[:-1]) + ",\n  " + sql[-1]


ORACLE["op13_vector_codes"] = _codes_sql()


@query
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.codes(vector_codes.encoded(table(spark, folder, "embeddings")))
