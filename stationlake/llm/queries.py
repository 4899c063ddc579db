"""The registered queries opN_<name> and their SQL, one per operator of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, html_text, language_id, nearest, pack, periodic_runs, quality_rules, substring_dedup, token_counts, token_files, warc
from .near_dup import near_duplicates


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"), width=3, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_documents(spark, sf_dir), width=35)


def _tokenizer(name: str) -> str:
    """Place of a public tokenizer's file on the driver; it is a parameter of the operators."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(_documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_near_dup": op2_near_dup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_files": op7_token_files,
    "op8_token_counts": op8_token_counts,
    "op9_html_text": op9_html_text,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_nearest": op13_nearest,
}

ORACLES: dict[str, str] = {
    "op10_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
                   FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS lowest FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN f.lowest < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.lowest < p.page_id THEN f.lowest END AS refers_to
        FROM p LEFT JOIN f ON p.payload_bytes >= 100 AND p.payload_digest = f.payload_digest""",
    "op4_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
                   FROM documents),
        s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
        h AS (SELECT s.doc_id, s.i, array_to_string(d.w[s.i:s.i + 34], ' ') AS t FROM s JOIN d USING (doc_id)),
        r AS (SELECT t FROM h GROUP BY t HAVING count(*) > 1),
        g AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 35)) AS i FROM h JOIN r USING (t)),
        k AS (SELECT doc_id, list(i ORDER BY i) AS gone FROM g GROUP BY doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(k.gone), 0) AS n_removed,
               sha256(CASE WHEN k.gone IS NULL THEN array_to_string(d.w, ' ') ELSE coalesce(array_to_string(
                   list_filter(list_transform(d.w, lambda x, i: CASE WHEN list_contains(k.gone, i) THEN NULL ELSE x END),
                               lambda x: x IS NOT NULL), ' '), '') END) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op12_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
              UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
              UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
        f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS v, count(*)::HUGEINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
        n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
        c AS (SELECT lang, phrase, f AS a, 1 AS cut, v[1] AS head, array_to_string(v[2:], ' ') AS tail FROM f WHERE k > 1
              UNION ALL SELECT lang, phrase, f, 2, v[1] || ' ' || v[2], v[3] FROM f WHERE k = 3),
        s AS (SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f * y.f) AS score,
                     row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (1000000::HUGEINT * a * a) // (x.f * y.f), cut) AS best
              FROM c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail),
        o AS (SELECT lang, phrase, max(f) AS longer FROM (
                  SELECT lang, v[1] || ' ' || v[2] AS phrase, f FROM f WHERE k = 3
                  UNION ALL SELECT lang, v[2] || ' ' || v[3], f FROM f WHERE k = 3) GROUP BY lang, phrase),
        t AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
              FROM s LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase
              WHERE best = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
        SELECT t.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM t JOIN n ON n.lang = t.lang WHERE rank <= 2000""",
}
