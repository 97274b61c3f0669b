"""New cohort files -> the release plan, one micro-batch at a time.

The studied tool is run again and again on lists of subjects and skips a
package that already exists.  Here a Structured Streaming source watches
the cohort folder; each micro-batch of new cohort rows goes through
``build_release`` with the packages delivered by earlier batches as
``existing`` (E18, left-anti); the manifest, issues, outcomes, the batch's part
of the summary and (outside a dry run) the ledger are written, then the batch's
marker (``operators/commit.py``).  A withdrawn package is not delivered, so a
later batch makes it again.  The stream's checkpoint lies below the output
folder and makes a restarted job continue after the last committed batch.  A
replayed batch looks only at committed batches before it, so it makes its rows
again and replaces them.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import commit, outcome
from ..plans.pipeline import SUMMARY_DIMS, SUMMARY_MEASURES, ReleaseInputs, ReleaseParams, build_release
from ..session import drop_scratch


def _delivered_before(spark: SparkSession, out_dir: str, batch_id: int) -> DataFrame | None:
    """Packages delivered by the committed batches before ``batch_id``; None before the first one."""
    earlier = commit.committed(spark, out_dir, "outcomes", "batch_id")
    return None if earlier is None else outcome.delivered(earlier.where(F.col("batch_id") < batch_id))


def read_summary(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """Summary of all committed batches: their parts added up, as if they had been one batch."""
    parts = commit.committed(spark, out_dir, "summary", "batch_id")
    return None if parts is None else outcome.merge_summary(parts, SUMMARY_DIMS, list(SUMMARY_MEASURES))


def release_stream(spark: SparkSession, cohort_dir: str, inputs: Callable[[DataFrame], ReleaseInputs],
                   params: ReleaseParams, out_dir: str, checkpoint_location: str | None = None,
                   available_now: bool = True):
    """Start the incremental release; returns the StreamingQuery.

    ``inputs(cohort_batch)`` returns the other (static) inputs with the
    batch as cohort.  Outputs go to ``out_dir``/{manifest,issues,ledger,outcomes,summary,commits}
    (``commit.committed`` and ``read_summary`` read them), the stream's state to ``out_dir``/stream-state by default.
    """
    ckpt = checkpoint_location or os.path.join(out_dir, "stream-state")

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        inp = inputs(batch)
        inp.existing = _delivered_before(spark, out_dir, batch_id)
        out = build_release(spark, inp, params)
        try:
            outputs = {"manifest": out.manifest, "issues": out.issues, "outcomes": out.outcomes,
                       "summary": out.summary_part}
            if not params.dry_run:
                outputs["ledger"] = out.ledger
            commit.write_attempt(spark, out_dir, "batch_id", batch_id, outputs, {"ledger": ("run_date", "modality")})
        finally:
            drop_scratch(spark, out.extra["scratch"])   # the batch's stage tables are done with

    reader = spark.readStream.schema(schemas.COHORT).option("header", "true").csv(cohort_dir)
    writer = reader.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
