"""The registered queries of the operators, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import (
    ann,
    html_text,
    language,
    lm,
    mixing,
    near_vectors,
    packing,
    prefixes,
    quality,
    repeats,
    secrets,
    simhash,
    variants,
)
from tillhouse.llm.shared import stored

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_nearest_neighbours(spark, folder):
    table = _table(spark, folder, "embeddings")
    index = stored(ann.build_index(table, 20), "index")
    return ann.search(index, table.filter(F.col("vec_id") % 20 == 0), 20)


@_query
def op2_quality_rules(spark, folder):
    return quality.quality_report(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op3_source_mixing(spark, folder):
    rows = mixing.mix_rows(_table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op4_suffix_array_dedup(spark, folder):
    return repeats.without_repeats(_table(spark, folder, "documents"))


@_query
def op5_lm_scores(spark, folder):
    return lm.lm_scores(_table(spark, folder, "documents"))


@_query
def op6_simhash_near_dedup(spark, folder):
    return simhash.simhash_components(_table(spark, folder, "documents"))


@_query
def op7_vector_best_fit_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents"))


@_query
def op8_secret_scans(spark, folder):
    docs = _table(spark, folder, "documents")
    return secrets.secret_report(docs, secrets.train(secrets.labelled_samples(docs)))


@_query
def op9_html_extraction(spark, folder):
    pages = _table(spark, folder, "pages")
    return html_text.extract(pages, html_text.fit(pages))


@_query
def op10_language_id(spark, folder):
    docs = _table(spark, folder, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    found = language.classify(docs, model).withColumn("held_out", language.held_out())
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@_query
def op11_spelling_variants(spark, folder):
    return variants.spelling_variants(_table(spark, folder, "documents"))


@_query
def op12_embedding_near_dedup(spark, folder):
    return near_vectors.near_vectors(_table(spark, folder, "embeddings"))


@_query
def op13_conversation_prefix_trie(spark, folder):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return prefixes.prefix_trie(_table(spark, folder, "conversations")).select(*columns)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    space = quality.SPACE
    return rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT r, doc_id, text,
                     list_filter(string_split_regex(text, '{space}+'), lambda x: x <> '') AS w,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
              FROM d),
        windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
                    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
        starts AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM starts) GROUP BY r),
        m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                     CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                     CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                     CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                     len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop, len(ls) AS n_lines,
                     len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…){space}*$'))) AS n_dots,
                     len(list_filter(ls, lambda x: regexp_matches(x, '^{space}*[-*•‣▪]'))) AS n_bullets
              FROM w LEFT JOIN repeats USING (r)),
        v AS (SELECT *, n_words < {quality.MIN_WORDS}
                        OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND word_chars / n_words BETWEEN 3 AND 10 AND n_symbols / n_words <= 0.1
                   AND n_stop / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5
                   AND n_dots / n_lines <= 0.3 AND n_bullets / n_lines <= 0.9 AS kept
        FROM v"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _quality_sql()}
