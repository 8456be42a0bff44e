"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's `docs`. Labels come from `sf_dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelweave.lineage import durable
from panelweave.llm.language_id import fit_prototypes, keep_known
from panelweave.llm.near_duplicates import drop_near_duplicates
from panelweave.llm.packing import pack
from panelweave.llm.personal_data import mask_personal_data
from panelweave.llm.quality import fit_quality, keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the predicted one replaces a `lang` that is missing or contradicted."""
    return keep_known(docs, fit_prototypes(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of at most 1024."""
    import public_tokenizers

    path = public_tokenizers.path
    return pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

ORACLE_SQL = None  # models are trained on the way


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
