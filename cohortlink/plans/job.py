"""Job entry: the release for one site and modality list, whole cohort.

    spark-submit cohortlink/plans/job.py --cohort subjs.csv --site chla --modality dMRI \\
        --catalog catalog.csv --containers containers.parquet --inventory files.parquet \\
        --registry registry.txt --locations locations.csv --out /release/run1 [--nowrite]

The same inputs as the studied shell loop (subjects file, site, modality),
for all subjects in one job.  ``--nowrite`` is the dry run: packages are
listed but nothing is submitted or recorded in the ledger.
"""

from __future__ import annotations

import argparse
import datetime
import os
import sys
from functools import reduce

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from cohortlink.operators import commit, outcome  # noqa: E402
from cohortlink.plans.pipeline import ReleaseInputs, ReleaseParams, build_release  # noqa: E402
from cohortlink.session import drop_scratch, get_spark  # noqa: E402
from cohortlink.sources import listing, readers  # noqa: E402


def parse(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--cohort", required=True)
    p.add_argument("--site")
    p.add_argument("--site-mode", default="column", choices=["column", "row"])
    p.add_argument("--modality", action="append", required=True)
    p.add_argument("--catalog", required=True)
    p.add_argument("--containers", required=True)
    found = p.add_mutually_exclusive_group(required=True)
    found.add_argument("--inventory", help="parquet listing (path, name, parent, is_dir, length, ...)")
    found.add_argument("--list", action="append", help="root folder to list now, by tasks (may repeat)")
    p.add_argument("--registry", required=True)
    p.add_argument("--locations", required=True)
    p.add_argument("--registration")
    p.add_argument("--texts", action="append", default=[], help="glob of motion/bvals/bvecs files")
    p.add_argument("--replies", help="parquet table of delivery replies")
    p.add_argument("--existing", help="the --out folder of earlier runs (committed attempts count), or a parquet table "
                                      "of delivered packages (package, withdrawn); a withdrawn package is made again")
    p.add_argument("--out", required=True)
    p.add_argument("--attempt", help="name of the attempt (default: the time); a repeated one replaces its rows")
    p.add_argument("--nowrite", action="store_true")
    return p.parse_args(argv)


def existing_packages(spark, path: str, attempt: str | None):
    """Delivered packages of a run folder (committed attempts but ``attempt`` itself) or of a table."""
    outcomes = commit.committed(spark, path, "outcomes", "attempt")
    if outcomes is not None and attempt:
        outcomes = outcomes.where(outcome.F.col("attempt").cast("string") != attempt)
    if outcomes is None:
        outcomes = spark.read.parquet(path)
    return outcome.delivered(outcomes)


def main(argv=None, spark=None) -> None:
    a = parse(argv)
    own = spark is None
    spark = spark or get_spark()
    inp = ReleaseInputs(
        cohort=readers.read_cohort(spark, a.cohort),
        catalog=readers.read_catalog(spark, a.catalog),
        containers=readers.read_containers(spark, a.containers),
        files=(spark.read.parquet(a.inventory) if a.inventory else
               reduce(DataFrame.unionAll, [listing.list_tree(spark, root) for root in a.list])),
        registry=readers.read_registry(spark, a.registry),
        locations=spark.read.option("header", "true").csv(a.locations),
        registration=spark.read.parquet(a.registration) if a.registration else None,
        texts=readers.read_side_text(spark, a.texts) if a.texts else None,
        replies=spark.read.parquet(a.replies) if a.replies else None,
        existing=existing_packages(spark, a.existing, a.attempt) if a.existing else None)
    now = datetime.datetime.now(datetime.timezone.utc)
    attempt = a.attempt or now.strftime("%Y%m%dT%H%M%S")
    prm = ReleaseParams(modalities=a.modality, site=a.site, site_mode=a.site_mode, dry_run=a.nowrite,
                        attempt=attempt, run_date=now.strftime("%Y-%m-%d"))
    out = build_release(spark, inp, prm)
    try:
        outputs = {name: getattr(out, name) for name in ("runs", "runs_json", "manifest", "submission", "payload",
                                                         "outcomes", "issues", "summary")}
        if not a.nowrite:
            outputs["ledger"] = out.ledger
        commit.write_attempt(spark, a.out, "attempt", attempt, outputs, {"ledger": ("run_date", "modality")})
    finally:
        drop_scratch(spark, out.extra["scratch"])   # stage tables are of no use after the writes
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
