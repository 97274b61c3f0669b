"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, masking of personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies
them to ``documents``, each stage's rows written as Parquet and reread as the
next one's input.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.llm import bpe, line_dedup, minhash, packing, pii, quality
from cohortlink.llm.common import materialise, prepare, table


#: words of a shingle in the near-duplicate stage (two words are the contract of the op9 query only)
STAGE_SHINGLE = 5


def with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and compression bands keep."""
    prepare(spark)
    return quality.keep_good(docs)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur earlier; a document with no line left goes."""
    prepare(spark)
    return with_length(line_dedup.drop_repeats(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (0.8 similar on five-word shingles)."""
    prepare(spark)
    found = minhash.near_duplicates(docs, words=STAGE_SHINGLE).where("not kept").select("doc_id", "text_hash").distinct()
    # the document's own columns stay inside a struct, so none can clash with the found ones
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own_hash"))
    gone = (F.col("own_id") == F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    return rows.join(found, gone, "left_anti").select("doc.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    prepare(spark)
    return with_length(pii.mask(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    prepare(spark)
    return packing.pack_documents(docs, bpe.tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_repeats), ("minhash_near_dedup", near_duplicates),
          ("pii_masking", personal_data), ("packing", pack)]

#: SQL cannot express compression ratios, signatures and packing; tests/llm/test_pipeline.py checks the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
