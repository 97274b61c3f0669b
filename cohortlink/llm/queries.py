"""Registered queries of the training-data operators and their DuckDB oracles.

Each query applies its operator to the whole intended table with production
parameters.  SQL is given where it can express the result in reasonable time;
the other queries are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlink.llm import (align, bpe, embed_dedup, fim, licences, line_dedup, minhash, packing, pii, quality,
                            shard, suffix_dedup, toxicity)
from cohortlink.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op5_licence_digest_lookup": licences.oracle_sql(),
                       "op6_line_deletion_neighbourhood": line_dedup.ORACLE_SQL,
                       "op11_fim_chunk_memo": fim.ORACLE_SQL}
#: queries without SQL, and the test module that holds their brute-force version
WITHOUT_SQL = {"op1_embedding_int8_tiles": "test_near_dup", "op2_suffix_array_dedup": "test_suffix_dedup",
               "op3_pii_context_bootstrap": "test_pii", "op4_toxicity_weak_supervision": "test_toxicity",
               "op7_quality_compression_bands": "test_quality", "op8_pack_karmarkar_karp": "test_packing",
               "op9_minhash_coordinate_join": "test_near_dup", "op10_bpe_round_trip": "test_bpe",
               "op12_align_pointer_jumping": "test_align", "op13_shard_hilbert_curve": "test_shard",
               "pipeline": "test_pipeline"}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_embedding_int8_tiles(spark, sf_dir):
    """Cosine links of all embeddings and their components."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document that lie in a 100-byte string seen earlier."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_pii_context_bootstrap(spark, sf_dir):
    """Personal data of every document: base spans and spans of confident contexts."""
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op4_toxicity_weak_supervision(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_licence_digest_lookup(spark, sf_dir):
    """Licence texts and notices in every document."""
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op6_line_deletion_neighbourhood(spark, sf_dir):
    """Every document without the lines that occur earlier, equal or one edit away."""
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op7_quality_compression_bands(spark, sf_dir):
    """Base counts, compression ratios and verdict of every document."""
    return quality.rate(table(spark, sf_dir, "documents"))


@query
def op8_pack_karmarkar_karp(spark, sf_dir):
    """Every document's tokens packed into sequences of at most 2048."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


@query
def op9_minhash_coordinate_join(spark, sf_dir):
    """Components of documents that are similar on two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_bpe_round_trip(spark, sf_dir):
    """Every document encoded and decoded by the streaming transducer."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


@query
def op11_fim_chunk_memo(spark, sf_dir):
    """Every document cut and reordered for fill-in-middle training."""
    return fim.digests(table(spark, sf_dir, "documents"))


@query
def op12_align_pointer_jumping(spark, sf_dir):
    """Every document tokenized twice, aligned, and its links scored by corpus-wide counts."""
    return align.score(table(spark, sf_dir, "documents"))


@query
def op13_shard_hilbert_curve(spark, sf_dir):
    """Every document's shard and slot: runs of equal row counts along a Hilbert curve."""
    return shard.assign(table(spark, sf_dir, "documents"))
