"""Commit record of an attempt.

A job writes several outputs, one after the other, and can stop between any
two.  Each output's rows of an attempt lie in a folder of their own,
``<out>/<name>/<key>=<attempt>``, and a marker row is written last, to
``<out>/commits/<key>=<attempt>``.  Readers take only attempts with a marker, so
a package does not count as existing, and a ledger row does not count, unless
all outputs of its attempt are there.  A repeated attempt replaces its folders
whole, also with fewer or no rows, and its marker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = "commits"


def _folder(out_dir: str, name: str, key: str, attempt) -> str:
    return f"{out_dir.rstrip('/')}/{name}/{key}={attempt}"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:   # nothing written yet, or nothing but an attempt that stopped in its first task
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_output(df: DataFrame, out_dir: str, name: str, key: str, attempt,
                 partition_cols: Sequence[str] = ()) -> None:
    """The attempt's rows of one output, instead of those an earlier try of it left."""
    df.drop(key).write.mode("overwrite").partitionBy(*partition_cols).parquet(_folder(out_dir, name, key, attempt))


def mark(spark: SparkSession, out_dir: str, key: str, attempt, outputs: Sequence[str]) -> None:
    """The attempt's marker: it makes the attempt's rows count."""
    row = spark.createDataFrame([(list(outputs),)], "outputs array<string>")
    row.coalesce(1).write.mode("overwrite").parquet(_folder(out_dir, MARKERS, key, attempt))


def committed(spark: SparkSession, out_dir: str, name: str, key: str) -> DataFrame | None:
    """The output's rows of all attempts with a marker; None before the first one.

    An output that an attempt did not write (no ledger in a dry run) is
    None as long as no attempt wrote it.
    """
    marks, rows = _read(spark, f"{out_dir.rstrip('/')}/{MARKERS}"), _read(spark, f"{out_dir.rstrip('/')}/{name}")
    if marks is None or rows is None:
        return None
    done = marks.where(F.array_contains("outputs", name)).select(F.col(key).cast("string").alias("__done")).distinct()
    return rows.join(done, F.col(key).cast("string") == F.col("__done"), "left_semi")


def write_attempt(spark: SparkSession, out_dir: str, key: str, attempt, outputs: dict[str, DataFrame],
                  partition_cols: dict[str, Sequence[str]] | None = None) -> None:
    """All outputs of an attempt, then its marker."""
    for name, df in outputs.items():
        write_output(df, out_dir, name, key, attempt, (partition_cols or {}).get(name, ()))
    mark(spark, out_dir, key, attempt, list(outputs))
