"""Readers (O01-O08).  Explicit schemas, no inference; only needed columns
are selected so CSV and parquet scans are pruned (``ReadSchema``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims, schemas
from ..functions import rules as R
from ..session import cut_lineage


def _read(spark: SparkSession, path, fmt: str, schema: T.StructType | None = None, **opts) -> DataFrame:
    try:
        r = spark.read.options(**opts)
        if schema is not None and fmt != "parquet":
            r = r.schema(schema)
        return r.format(fmt).load(path)
    except AnalysisException as e:  # PATH_NOT_FOUND and friends
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise


def _project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns with the schema's types (try_cast)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


# ------------------------------------------------------------------ O01
def read_cohort(spark: SparkSession, path, fmt: str = "csv",
                schema: T.StructType = schemas.COHORT) -> DataFrame:
    """Cohort table; a missing file raises FileNotFoundError (the exists check)."""
    if fmt == "csv":
        return _read(spark, path, "csv", schema, header="true", mode="PERMISSIVE", quote='"', escape='"')
    return _project(_read(spark, path, fmt), schema)


# ------------------------------------------------------------------ O02
def read_catalog(spark: SparkSession, path, fmt: str = "csv",
                 schema: T.StructType = schemas.CATALOG) -> DataFrame:
    """Scan catalogue: only the schema's columns are read (8 of 39).

    CSV: the header names the columns; everything is read as text and cast
    here, so ``StudyDate`` keeps its form and only ``SeriesTime`` is numeric.
    """
    if fmt == "csv":
        df = _read(spark, path, "csv", header="true", inferSchema="false", quote='"', escape='"')
    else:
        df = _read(spark, path, fmt)
    return _project(df, schema)


# ------------------------------------------------------------------ O03
def read_registry(spark: SparkSession, path, columns: Sequence[str] = tuple(schemas.REGISTRY_COLUMNS),
                  sep: str = "\t") -> DataFrame:
    """Registry of earlier uploads: TSV with a header and a description line.

    All columns are text; quoting as pandas reads it (a quote inside a
    quoted field is doubled).  The description line, the first row after the
    header of each file, is dropped by its place; a data row with an empty or
    odd id stays.  ``src_order`` numbers the rows 0, 1, ... as they stand in the
    files (by file path), whatever the split sizes: one long, needed for "the
    last match wins".

    The text is scanned once, into a stage table below the checkpoint folder
    with each row's split and its number in the task; the number of rows per
    split is a small aggregate of that table (``number_rows``).
    """
    df = _read(spark, path, "csv", header="true", sep=sep, inferSchema="false",
               quote='"', escape='"', multiLine="false")
    rows = cut_lineage(df.select(*columns, F.col("_metadata.file_path").alias("__file"),
                                 F.col("_metadata.file_block_start").alias("__block"),
                                 F.monotonically_increasing_id().alias("__row")), "registry")
    numbered = number_rows(rows, ["__file", "__block"], "__row", "src_order", first_of="__file")
    return numbered.where(F.col("src_order") > F.col("__first")).select(*columns, "src_order")


def number_rows(rows: DataFrame, split: Sequence[str], row: str, out: str, first_of: str) -> DataFrame:
    """Dense number of every row in the order of its split, without a sort.

    ``split`` are the columns that name a split, in the order splits follow
    each other; the values of ``row`` rise by one from row to row within a
    split (``monotonically_increasing_id`` over a file scan).  Rows per split
    and their lowest value are one partial aggregate; the prefix sums over
    splits are the offsets.  The offsets are one row per split, as many as the
    scan had tasks at most, so they go into one window and are broadcast.
    Adds ``out`` (long) and ``__first``, the number of the first row of the
    row's ``first_of`` group of splits (the file).
    """
    s = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__low"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(*[F.col(c).alias(f"__s_{c}") for c in split], "__low",
                 F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    s = s.withColumn("__first", F.min("__before").over(Window.partitionBy(f"__s_{first_of}")))
    same = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in split]
    return (rows.join(F.broadcast(s), same)
                .withColumn(out, F.col("__before") + F.col(row) - F.col("__low"))
                .drop("__low", "__before", *[f"__s_{c}" for c in split]))


# ------------------------------------------------------------------ O04
def plain_path(path_col, encoded: bool = False):
    """Path without scheme and authority, the one form in which paths of all
    sources meet; ``encoded`` also undoes percent-encoding (``_metadata``)."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    if encoded:
        p = F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)
    return F.regexp_replace(p, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")


def with_path_parts(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``name`` (last part) and ``parent`` (all before the last ``/``)."""
    p = F.col(path_col)
    return (df.withColumn("name", F.substring_index(p, "/", -1))
              .withColumn("parent", R.parent_path(p)))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Listing of every file below ``root`` (schema ``schemas.FILES``).

    ``binaryFile`` with the content column not selected reads no bytes
    (``ReadSchema: struct<path,length,modificationTime>``).  At archive size
    the listing goes through the driver's file index; store it once as a
    parquet inventory and read that instead.
    """
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(plain_path("path").alias("path"), "length",
                       F.col("modificationTime").alias("modification_time")))
    return with_path_parts(df).select("path", "name", "parent", F.lit(False).alias("is_dir"),
                                      "length", "modification_time")


def with_directories(files: DataFrame) -> DataFrame:
    """Listing plus one ``is_dir`` row per folder above a listed entry
    (``directories``)."""
    return files.unionByName(directories(files))


def directories(files: DataFrame) -> DataFrame:
    """One ``is_dir`` row per folder above a listed entry, at any depth (a
    folder may hold only sub-folders), that has no folder row yet.

    A listing of files sees a folder only through its files (K24); rows
    already marked ``is_dir`` are kept.  Only the distinct parents are
    expanded to their ancestors, de-duplicated (partial aggregates) and
    anti-joined with the folder rows already present; the file rows
    themselves are never shuffled.  The root and a bare ``scheme:`` are no
    folders.
    """
    known = files.where(F.col("is_dir")).select("path")
    parts = F.split(F.col("parent"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return (files.select("parent").distinct().select(F.explode(above).alias("path")).distinct()
                 .where((F.col("path") != "") & ~F.col("path").rlike("[/:]$"))
                 .join(known, "path", "left_anti")
                 .transform(with_path_parts)
                 .select("path", "name", "parent", F.lit(True).alias("is_dir"),
                         F.lit(None).cast("long").alias("length"),
                         F.lit(None).cast("timestamp").alias("modification_time")))


def only_dirs(listing: DataFrame) -> DataFrame:
    """Directory rows only (K7: a real test, files never survive it)."""
    return listing.where(F.col("is_dir"))


# ------------------------------------------------------------------ O05
def read_containers(spark: SparkSession, path, fmt: str = "parquet",
                    schema: T.StructType = schemas.CONTAINERS) -> DataFrame:
    """Container metadata, one row per container, nested series and scans."""
    if fmt == "json":
        return _read(spark, path, "json", schema)
    return _read(spark, path, fmt).select(*[f.name for f in schema.fields])


def nest_rows(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str,
              order: Sequence[str] | None = None) -> DataFrame:
    """Pack rows into one array-of-struct column per key (container form).

    The order of ``order`` columns (default: ``fields``) decides array order.
    """
    order = list(order or fields)
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in fields])
    arr = F.array_sort(F.collect_list(packed))
    return (df.groupBy(*keys).agg(arr.alias("__a"))
              .select(*keys, F.transform("__a", lambda x: F.struct(*[x[c].alias(c) for c in fields]))
                       .alias(name)))


# ------------------------------------------------------------------ O06
def resolve_root(dim: DataFrame, locations: DataFrame, project: str,
                 selector: str = "root_column", suffix: str = "root_sub",
                 key: str = "ProjID", options: Sequence[str] = ("proc", "proc_dti", "proc_bold")) -> DataFrame:
    """Root folder per dimension row: in the location row of ``project``
    (the matching row wherever it stands, K8) the column named by
    ``selector``, then ``suffix``.

    The location row is unpivoted to (column name, value) and equi-joined on
    the column name: no cross join.  Several rows for one project: the
    smallest value per column, deterministic.
    """
    pairs = ", ".join(f"'{o}', cast(`{o}` as string)" for o in options)
    long = (locations.where(F.col(key) == F.lit(project))
                     .selectExpr(f"stack({len(options)}, {pairs}) as (__col, __val)")
                     .groupBy("__col").agg(F.min("__val").alias("__val")))
    joined = dim.join(F.broadcast(long), F.col(selector) == F.col("__col"), "left")
    return joined.withColumn("root", F.concat(F.col("__val"), F.col(suffix))).drop("__col", "__val")


# ------------------------------------------------------------------ O07
def parse_motion(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Blank-separated numbers -> motion columns; the last two are dropped."""
    parts = F.split(F.trim(F.col(value_col)), r"\s+")
    cols = [F.get(parts, i).try_cast("long" if i == 0 else "double").alias(c)
            for i, c in enumerate(dims.MOTION_COLUMNS)]
    keep = [c for c in df.columns if c != value_col]
    return df.where(F.trim(F.col(value_col)) != "").select(*keep, *cols)


def read_motion(spark: SparkSession, paths) -> DataFrame:
    """Motion text files, one row per line with its file path."""
    df = spark.read.text(paths).select(plain_path("_metadata.file_path", encoded=True).alias("path"), "value")
    return parse_motion(df)


# ------------------------------------------------------------------ O08
def read_side_text(spark: SparkSession, paths) -> DataFrame:
    """Whole text files (bvals, bvecs) carried unchanged, with their size;
    ``path`` has the form of the inventory's (``plain_path``)."""
    df = spark.read.text(paths, wholetext=True)
    return df.select(plain_path("_metadata.file_path", encoded=True).alias("path"), F.col("value").alias("text"),
                     F.octet_length("value").alias("size"), *[c for c in df.columns if c != "value"])
