"""Operator 13: sharding along a Hilbert curve.

Rows are ordered by several metadata dimensions at once and cut into runs, one
per shard, so that every shard covers a compact box of the dimensions and a
reader with a filter on any of them skips most shards.

Each dimension is quantised by its own distribution: the cell of a value is its
rank among all rows, in 2 ** bits steps.  Only distinct values are sorted for
that, and only the cells' lower bounds (at most 2 ** bits values a dimension)
come to the driver.  The cells of a row are a point of a cube, and the place of
that point on the Hilbert curve is its index.  Rows of equal text take the
smallest index of their group and stand next to each other, so a group is only
cut where a shard ends.  The order is a range-partitioned sort by (index, digest
of the text, id, row number), in which neither a common value nor a group of
copies is kept in one task; a row's rank is its number in its partition plus the
rows of the partitions before (one number a partition comes to the driver).

Law ``rows``: shard = rank * shards // rows, so counts differ by one at most.

Defined cases: a null text has no bytes, and a null in a dimension is the lowest
value (so is NaN); null or repeated ids and repeated rows keep a place
each; a table with fewer rows than shards leaves shards empty; an empty table
gives no rows; columns of any name are carried without clashing.
"""

from __future__ import annotations

import bisect
import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, prepare

SHARDS = 24
#: what a row costs besides its text
ROW_BYTES = 8
#: the query's dimensions: two columns and the size of the text
SIZE = "size"
DIMENSIONS = ("lang", "source", SIZE)
#: cells a dimension is cut into: 2 ** BITS (fewer with more than seven dimensions, so that an index is one long)
BITS = 8
#: Spark numbers rows as partition << 33 | row
PART_BITS = 33


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (rows, dimensions), by Skilling's transposition:
    from the top bit down, the lower bits of the first axis are mirrored or swapped as the part of the
    cube demands; a Gray code over the axes' bits, read across the axes, is the index."""
    axes = [c.astype(np.int64) for c in cells.T]
    last = len(axes) - 1
    for top in (1 << k for k in range(bits - 1, 0, -1)):
        low = top - 1
        for axis in range(last + 1):
            upper = (axes[axis] & top) != 0
            swap = np.where(upper, 0, (axes[0] ^ axes[axis]) & low)
            axes[0] = axes[0] ^ swap ^ np.where(upper, low, 0)
            if axis:
                axes[axis] = axes[axis] ^ swap
    for axis in range(last):
        axes[axis + 1] ^= axes[axis]
    turn = np.zeros(len(cells), np.int64)
    for top in (1 << k for k in range(bits - 1, 0, -1)):
        turn ^= np.where(axes[last] & top, top - 1, 0)
    index = np.zeros(len(cells), np.int64)
    for k, axis in itertools.product(range(bits - 1, -1, -1), range(last + 1)):
        index = index << 1 | (axes[axis] ^ turn) >> k & 1
    return index


def _before(df: DataFrame, part: str, total: Column) -> tuple[DataFrame, int]:
    """``df`` with ``before``, the totals of all earlier partitions, and the total of all."""
    totals = sorted(df.groupBy(F.col(part).alias("part_no")).agg(total.alias("n")).collect())   # one row a partition
    before = list(itertools.accumulate((n for _, n in totals), initial=0))
    table = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part_no long, before long")
    return df.join(F.broadcast(table), F.col(part) == F.col("part_no")).drop("part_no"), before[-1]


def _in_order(df: DataFrame, *keys: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def lower_bounds(rows: DataFrame, dims: list[str], bits: int = BITS) -> list[list[tuple[int, object]]]:
    """Per column of ``dims``: (cell, smallest value) of the cells that hold rows, ascending.

    A value's cell is (rows with smaller values) * 2 ** bits // rows; nulls are
    left out.  All columns go through one sort: their distinct values are rows
    of one table, told apart by the grouping id.
    """
    gid = {d: 2 ** len(dims) - 1 - 2 ** (len(dims) - 1 - k) for k, d in enumerate(dims)}
    own = functools.reduce(lambda a, b: a | b, [(F.col("gid") == g) & F.col(d).isNotNull() for d, g in gid.items()])
    counts = rows.groupingSets([[F.col(d)] for d in dims], *dims).agg(
        F.grouping_id().cast("long").alias("gid"), F.count("*").alias("n")).where(own).select("gid", "n", *dims)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema if f.name in gid)

    def running(batches):
        """``inside``: rows of the partition before this value."""
        upto = 0
        for b in batches:
            n = b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto + np.cumsum(n) - n)], [*b.schema.names, "inside"])
            upto += int(n.sum())
    values = _in_order(counts, "gid", *dims).withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
        running, f"gid long, n long, {kinds}, part long, inside long")
    values, _ = _before(materialise(values, "values"), "part", F.sum("n"))
    totals = dict(values.groupBy("gid").agg(F.sum("n")).collect())   # one row a dimension
    first = dict(zip(sorted(totals), itertools.accumulate((totals[g] for g in sorted(totals)), initial=0)))
    out = []
    for d, g in gid.items():
        if g not in totals:
            out.append([])
            continue
        rank = (F.col("before") + F.col("inside") - first[g]).cast("decimal(38,0)") * 2 ** bits
        cells = values.where(F.col("gid") == g).groupBy(F.floor(rank / F.lit(totals[g])).cast("long").alias("cell"))
        out.append(sorted(tuple(r) for r in cells.agg(F.min(d)).collect()))   # at most 2 ** bits rows
    return out


def _curve(bounds: list[list[tuple[int, object]]], bits: int):
    cells = [np.array([0, *(c for c, _ in b)], np.int64) for b in bounds]
    lows = [[v for _, v in b] for b in bounds]

    def run(*dims: pa.Array) -> pa.Array:
        point = np.empty((len(dims[0]), len(dims)), np.int64)
        for k, dim in enumerate(dims):
            coded = dim.dictionary_encode(null_encoding="encode")
            cell = np.array([0 if v is None else cells[k][bisect.bisect_right(lows[k], v)]
                             for v in coded.dictionary.to_pylist()], np.int64)
            point[:, k] = cell[coded.indices.to_numpy()]
        return pa.array(hilbert(point, bits), pa.int64())
    return run


def _dimension(docs: DataFrame, name: str, size: Column) -> Column:
    if name == SIZE and name not in docs.columns:
        return size
    kind = docs.schema[name].dataType.typeName()
    c = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("float", "double"):
        return F.when(~F.isnan(c), c)
    return c.cast("int") if kind == "boolean" else c


def _placed(docs: DataFrame, shards: int, dimensions, bits: int, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Every row with size, crc, ``curve``, ``shard`` and ``slot``; ``row`` holds its own columns if ``carry``."""
    prepare(docs.sparkSession)
    bits = min(bits, 62 // len(dimensions))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + ROW_BYTES
    dims = [f"d{k}" for k in range(len(dimensions))]
    rows = materialise(docs.select(
        F.col(id_col).alias("id"), size.alias("bytes"), F.crc32(text).alias("crc"), F.unhex(F.md5(text)).alias("digest"),
        *(_dimension(docs, name, size).alias(d) for name, d in zip(dimensions, dims)),
        *([F.struct(*docs.columns).alias("row")] if carry else []),
        F.monotonically_increasing_id().alias("no")), "shard-rows")
    bounds = lower_bounds(rows, dims, bits)
    rows = rows.withColumn("curve", F.arrow_udf(_curve(bounds, bits), "long")(*dims)).drop(*dims)
    groups = rows.groupBy("digest").agg(F.min("curve").alias("lowest"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(groups.select("digest", "lowest"), "digest", "left").withColumn(
        "place", F.coalesce("lowest", "curve")).drop("lowest")
    rows = materialise(_in_order(rows, "place", "digest", "id", "no").withColumn(
        "at", F.monotonically_increasing_id()), "shard-order")
    rows, n = _before(rows.withColumn("part", F.shiftright("at", PART_BITS)), "part", F.count("*"))
    rank = F.col("before") + F.col("at").bitwiseAND(2 ** PART_BITS - 1)
    rows = rows.withColumn("shard", F.expr(f"(before + (at & {2 ** PART_BITS - 1})) * {shards} div {max(n, 1)}"))
    return rows.withColumn("slot", rank - F.expr(f"(shard * {n} + {shards - 1}) div {shards}"))


def assign(docs: DataFrame, shards: int = SHARDS, dimensions=DIMENSIONS, bits: int = BITS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), curve (the row's own index)."""
    return _placed(docs, shards, dimensions, bits, id_col, text_col, carry=False).select(
        F.col("id").alias("doc_id"), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def write(docs: DataFrame, path: str, shards: int = SHARDS, dimensions=DIMENSIONS, bits: int = BITS,
          id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard") -> None:
    """The table as Parquet, one folder per shard (``shard_col``), rows in curve order."""
    if shard_col in docs.columns:
        raise ValueError(f"the table has a column {shard_col!r}: name another shard_col")
    rows = _placed(docs, shards, dimensions, bits, id_col, text_col, carry=True).sortWithinPartitions("shard", "slot")
    rows.select("row.*", F.col("shard").alias(shard_col)).write.partitionBy(shard_col).parquet(path)


def ranges(table: DataFrame, columns, shard_col: str = "shard") -> DataFrame:
    """One row per shard: rows, and least and greatest value of each column (``<column>_least``, ``<column>_most``)."""
    return table.groupBy(shard_col).agg(F.count("*").alias("rows"), *(
        f(c).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "least"), (F.max, "most"))))


def overlapping(found: DataFrame, box: dict[str, tuple], shard_col: str = "shard") -> list[int]:
    """Shards of ``ranges`` that can hold rows with every column of ``box`` between its two bounds."""
    keep = F.lit(True)
    for c, (low, high) in box.items():
        keep = keep & (F.col(f"{c}_least") <= F.lit(high)) & (F.col(f"{c}_most") >= F.lit(low))
    return sorted(r[0] for r in found.where(keep).select(shard_col).collect())   # at most one row a shard
