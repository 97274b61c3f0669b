"""Small helpers of the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.session import cut_lineage, ensure_checkpoint_dir

#: rows of one Arrow batch handed to Python; texts can be long, so batches are small
ARROW_ROWS = 500
#: 64-bit words of a prefilter at most (64 keys to a word)
WORDS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings every operator relies on (idempotent)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only (null text: empty), whatever else the table carries."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and reread it: the
    lineage is cut and a lost executor costs at most the running stage.

    The shuffle files of the written stage are of no use any more; Spark frees
    them once the plan's objects are collected, which is asked for here."""
    out = cut_lineage(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def perhaps(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """``rows`` without most of those whose keys are not in ``wanted``; an exact join on the keys has to follow.

    Each wanted key sets one of 64 * WORDS bits by its hash; the words, WORDS at most however many keys are
    wanted, are broadcast, so only rows that may be wanted are shuffled for the join."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(64 * WORDS))
    word, mask = F.shiftright(bit, 6), F.expr(f"shiftleft(1L, int(pmod(xxhash64({', '.join(keys)}), 64)))")
    sent = wanted.groupBy(word.alias("word_of_bits")).agg(F.bit_or(mask).alias("bits"))
    return rows.withColumn("word_of_bits", word).withColumn("own_bit", mask).join(F.broadcast(sent.select(
        F.col("word_of_bits").alias("w"), "bits")), (F.col("word_of_bits") == F.col("w")) & (F.col("own_bit").bitwiseAND(F.col("bits")) != 0),
        "left_semi").drop("word_of_bits", "own_bit")
