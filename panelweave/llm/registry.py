"""Queries of the corpus operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


@_query
def op9_html_main(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.html_main import extract_main

    return extract_main(_table(spark, folder, "pages"))


@_query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.language_id import identify_language

    return identify_language(_table(spark, folder, "documents"))


@_query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from panelweave.llm.packing import pack

    path = public_tokenizers.path
    return pack(_table(spark, folder, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


@_query
def op7_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.multiset_hash import edit_report

    return edit_report(_table(spark, folder, "documents"))


@_query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.quality import classify_quality

    return classify_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.personal_data import find_personal_data

    return find_personal_data(_table(spark, folder, "documents"))


@_query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.near_duplicates import near_duplicates

    return near_duplicates(_table(spark, folder, "documents")).drop("text_hash")


@_query
def op4_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from panelweave.llm.piece_codec import round_trip

    return round_trip(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op1_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.pitman_yor import score_texts

    return score_texts(_table(spark, folder, "documents"))


@_query
def op3_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.ranked_search import search

    docs = _table(spark, folder, "documents")
    return search(docs, docs.filter("doc_id % 100 = 0"))


@_query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.exact_dedup import exact_duplicates

    return exact_duplicates(_table(spark, folder, "documents"))


SQL["op13_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM r
"""


@_query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from panelweave.llm.spelling_variants import spelling_variants

    return spelling_variants(_table(spark, folder, "documents"))


@_query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from panelweave.llm.token_alignment import align_tokenizers

    path = public_tokenizers.path
    return align_tokenizers(
        _table(spark, folder, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"),
        ranks=path("byte_bpe_50k.tiktoken"),
    )
