"""Inventory of an archive, listed by tasks.

``binaryFile`` lists through the driver, which holds every entry of the tree.
Here the folders of one level are rows of a table: tasks list them, one
folder after the other, and write their entries; the folders among the entries
are the next level.  The driver only learns how many folders a level has.
Folders are dealt by a hash of their path, so a task gets folders from all over
the level, and a folder's entries stream out in batches.  A lost executor
repeats the folders of its running tasks; levels that are written stay.

Any file system that ``pyarrow.fs`` opens from the root's URI (a mounted path,
``file:``, ``hdfs:``, ``s3:``, ``gs:``) and that all executors reach.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .readers import with_path_parts

ENTRY = "path string, is_dir boolean, length long, modification_time timestamp"
_ENTRY = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("length", pa.int64()),
                    ("modification_time", pa.timestamp("us", tz="UTC"))])
#: entries of one batch that leaves a task, and folders a task should list
BATCH, FOLDERS_A_TASK = 10_000, 200


def _lister(root: str):
    """Lists folders (paths below the root's file system) within a task."""
    def run(batches):
        from pyarrow import fs

        files = fs.FileSystem.from_uri(root)[0] if "://" in root or root.startswith("file:") else fs.LocalFileSystem()
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                # a folder that went away since its parent was listed has no entries
                found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                for k in range(0, len(found), BATCH):
                    part = found[k:k + BATCH]
                    is_dir = [e.type == fs.FileType.Directory for e in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([e.path for e in part], pa.string()), pa.array(is_dir, pa.bool_()),
                        pa.array([None if d else e.size for e, d in zip(part, is_dir)], pa.int64()),
                        pa.array([e.mtime for e in part], _ENTRY.field(3).type)], schema=_ENTRY)
    return run


def list_tree(spark: SparkSession, root: str, hidden: bool = False) -> DataFrame:
    """Every file and folder below ``root`` (schema ``schemas.FILES``; the root itself is no row).

    As Spark's own listing, names that begin with ``_`` or ``.`` are left out with
    all below them, unless ``hidden``; unlike it, empty files are listed.  An
    empty or missing folder gives no rows.
    """
    from pyarrow import fs

    start = fs.FileSystem.from_uri(root)[1] if "://" in root or root.startswith("file:") else root.rstrip("/") or "/"
    levels, frontier, n = [], spark.createDataFrame([(start,)], "path string"), 1
    while n:
        parts = max(1, min(-(-n // FOLDERS_A_TASK), 4 * spark.sparkContext.defaultParallelism))
        found = frontier.repartition(parts, "path").mapInArrow(_lister(root), ENTRY)
        if not hidden:
            found = found.where(~F.substring_index("path", "/", -1).rlike("^[_.]"))
        level = cut_lineage(found, "listing-level")
        levels.append(level)
        frontier = level.where("is_dir").select("path")
        n = frontier.count()
    rows = reduce(lambda a, b: a.unionAll(b), levels)
    return with_path_parts(rows).select("path", "name", "parent", "is_dir", "length", "modification_time")
