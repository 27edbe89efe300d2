"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from noticeworks.llm import (
    classify, divergence, lexical, licenses, linedup, lm, mix, negatives, packing, partenum, positional, tokenfiles, topk,
)
from noticeworks.llm.common import read


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).withColumn("spans", licenses.span_text("spans"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality_rules(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(read(spark, sf_dir, "documents"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(read(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return negatives.hard_negatives(
        read(spark, sf_dir, "embeddings"), vec_id % 50 == 0, F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


QUERIES = {
    "op1_mix": op1_mix,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_quality_rules": op5_quality_rules,
    "op6_top_k": op6_top_k,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_pack": op8_pack,
    "op9_lm_scores": op9_lm_scores,
    "op10_token_files": op10_token_files,
    "op11_lexical_search": op11_lexical_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_decontamination": op13_decontamination,
    "pipeline": corpus_pipeline.run,
}

_BLANK = r"[\x20\x09-\x0D]+"
_TRIM = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _terms(text: str) -> str:
    """SQL for the list of terms of a text."""
    return rf"regexp_extract_all(translate(coalesce({text}, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL: dict[str, str] = {
    "op11_lexical_search": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_terms("text")} AS t FROM documents),
        z AS (SELECT count(*) FILTER (len(t) > 0) AS docs, sum(len(t))::BIGINT AS words FROM d),
        q AS (SELECT iid, item_id, term, count(*) AS times FROM (
                SELECT iid, item_id, unnest(t) AS term FROM (
                  SELECT row_number() OVER () AS iid, item_id, {_terms("text")} AS t FROM benchmark)) GROUP BY ALL),
        p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (
                SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
              FROM (SELECT term, count(*) AS df FROM p GROUP BY term), z),
        s AS (SELECT iid, item_id, rid, doc_id,
                sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
              FROM q JOIN w USING (term) JOIN p USING (term), z GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 20""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS x FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                     list_inner_product(a.x, b.x)::BIGINT AS score
              FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3""",
    "op13_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_terms("text")} AS t FROM documents),
        i AS (SELECT item_id, {_terms("text")} AS t, least({positional.WINDOW}, len(t)) AS k FROM benchmark),
        w AS (SELECT DISTINCT item_id, k, array_to_string(t[s:s + k - 1], ' ') AS g
              FROM (SELECT item_id, k, t, unnest(range(1, len(t) - k + 2)) AS s FROM i WHERE k > 0)),
        o AS (SELECT rid, s, k, array_to_string(t[s:s + k - 1], ' ') AS g
              FROM (SELECT rid, t, k, unnest(range(1, len(t) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM w) WHERE len(t) >= k)),
        m AS (SELECT rid, s, k, item_id FROM o JOIN w USING (k, g)),
        h AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS pos FROM m) GROUP BY rid),
        n AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM m) GROUP BY rid)
        SELECT doc_id, len(t) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (rid) LEFT JOIN n USING (rid)""",
    "op6_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::DOUBLE) AS x FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
              FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op2_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
        split AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
                         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d WHERE text IS NOT NULL),
        l AS (SELECT *, trim(line, {_TRIM}) AS k FROM split),
        held AS (SELECT source, k, count(DISTINCT rid) AS pages FROM l WHERE k <> '' GROUP BY source, k),
        hosts AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
        bad AS (SELECT held.source, k FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
                WHERE 100 * held.pages > {linedup.PERCENT} * hosts.pages AND held.pages >= {linedup.MIN_PAGES}),
        marked AS (SELECT l.*, bad.k IS NOT NULL AS dropped FROM l
                   LEFT JOIN bad ON l.source IS NOT DISTINCT FROM bad.source AND l.k = bad.k),
        done AS (SELECT rid, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped,
                        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text
                 FROM marked GROUP BY rid)
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
               CASE WHEN d.text IS NOT NULL THEN md5(done.text) END AS text_md5
        FROM d LEFT JOIN done USING (rid)""",
}
