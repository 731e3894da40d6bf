"""A training corpus from raw documents: quality rules, near-duplicates, personal data, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemloom.llm import bpe, mixing, nearcopies, privacy, quality
from itemloom.llm.common import tables
from itemloom.session import scratch, scratch_dir

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the model fitted on the labels of these documents.

    Null, empty and short texts go; rows are judged one by one, so ties and repeated rows share their fate.
    """
    return quality.kept_only(docs, quality.fit(docs, tables(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: by fingerprints, and five-word shingles with a similarity of 0.8 or more.

    Texts without words are one group; of a group the smallest id stays, a null one last, and of repeated rows one.
    """
    return nearcopies.deduplicated(docs, similarity=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and without the terms that reveal it; ``n_chars`` follows the text.

    Every row stays. A null text stays null and keeps its ``n_chars``, an empty one is empty; equal rows come out equal.
    """
    clean = privacy.sanitised(docs)
    size = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    Rows without words are never taken, a null source is one of its own; rows of one id and size take turns.
    """
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the id and the source of its document; a null or empty text has none."""
    return bpe.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id", "source"])


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("source mix", source_mix),
    ("BPE", token_ids),
]

#: boosted trees, XXH64 and BPE merges have no SQL form; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written to the shared folder and read again; what a stage writes for itself goes with it."""
    docs = tables(spark, sf_dir, "documents")
    for _, stage in STAGES:
        kept = scratch_dir(spark, "stage")
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(kept)
        docs = spark.read.schema(result.schema).parquet(kept)
    return docs
