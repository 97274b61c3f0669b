"""Operator 2: exact substring dedup with suffix arrays built by linear grouping.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller doc_id, or same document and earlier start) is removed.

1. *Cells.*  Every window of LENGTH bytes names its least GRAM-byte string (by
   hash, leftmost on ties) its anchor.  Equal windows have equal anchors at
   equal offsets.  A cell is a maximal run of windows with one anchor: about
   one per 35 bytes.  Only cells whose anchor occurs twice or more can hold a
   repeated window.
2. *Equal cells* are pre-aggregated to the earliest one; every window of a
   later one starts earlier elsewhere.
3. *Blocks.*  Distinct cells of one anchor meet in a block of anchors.  The
   block's text is sorted by ``gsaca.suffix_array``, SORTED symbols or one
   anchor at a time; neighbours that agree on LENGTH bytes are one string, and
   all but its earliest start are repeats.  Cells are first cut to the windows
   whose inner context (of at least LENGTH - GRID bytes) another cell shares;
   the others cannot repeat.  Equal parts are sorted once.
4. An anchor with more than HOT distinct cells would make an unbounded block.
   Its cells are cut in two by where their windows stand to the anchor
   (``halves``); the windows of a half share more bytes, the *core*, which
   takes the anchor's place.  Equal halves are pre-aggregated like cells, and
   cores that are still hot are cut again, at most until the core is the window.

Only anchors' hashes and positions are shuffled for the whole corpus.

Defined cases: a null text is empty; texts shorter than LENGTH are unchanged;
rows with a null id stay unchanged and repeat nothing; rows that share an id but
not the text are documents of their own, ordered by a hash of the text (``row``);
rows equal in both count as one document and get the same result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, prepare
from cohortlink.llm.gsaca import suffix_array

LENGTH = 100
GRAM = 32
GRID = 2
#: window starts taken at a time, so memory does not follow the longest text
SEGMENT = 1 << 20
#: bytes of cells a block should hold; distinct cells of one anchor that go to a block
BLOCK_BYTES = 1 << 19
HOT = 1000
#: symbols sorted at a time (more only for one anchor), so that the sorter's lists stay in the processor's cache
SORTED = 1 << 13

_P = 0x9E3779B97F4A7C15
_M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            a = np.full(max(n, 1 << 14), base, np.uint64)
            a[0] = 1
            _POWERS[k] = np.multiply.accumulate(a)
    return _POWERS[0], _POWERS[1]


class Hashes:
    """Hash of any substring of a byte array in constant time."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def cells(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Arrays (anchor hash, cell hash, start, bytes) of a text's cells."""
    parts, width = [], length - gram + 1
    for base in range(0, max(0, len(data) - length + 1), SEGMENT):
        own = data[base:base + SEGMENT + length - 1]
        h = Hashes(own)
        at = np.arange(len(own) - gram + 1)
        g = h.of(at, at + gram)
        low = g >> np.uint64(24) << np.uint64(24) | at.astype(np.uint64)
        step = 1
        while 2 * step <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
        anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.concatenate([first[1:], [len(anchor)]]) - 1 + length
        parts.append((g[anchor[first]], h.of(first, end), first + base, end - first))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*parts))


def cell_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, cell, doc_id, row, start, size: one row per cell."""
    names = ["anchor", "cell", "doc_id", "row", "start", "size"]

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part, rows = b.slice(k, 64), []
                for i, t, r in zip(*(part.column(k).to_pylist() for k in range(3))):
                    a, c, s, n = cells(np.frombuffer(t.encode(), np.uint8), length, gram)
                    rows.append((a.view(np.int64), c.view(np.int64), np.full(len(s), i, np.int64),
                                 np.full(len(s), r, np.int64), s, n))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], names)
    return docs.where("doc_id is not null").select("doc_id", "text", "row").mapInArrow(
        run, "anchor long, cell long, doc_id long, row long, start long, size long")


def block_spans(pdf: pd.DataFrame, length: int = LENGTH, gram: int = GRAM) -> pd.DataFrame:
    """Distinct cells of a block of anchors (anchor, doc_id, row, start, bytes) -> repeated spans doc_id, row, start, size.

    ``gram`` is the size of the core that the windows of a cell share.
    """
    pdf = _shared_parts(pdf.reset_index(drop=True), length, gram)
    empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("doc_id", "row", "start", "size")})
    if len(pdf) < 2:
        return empty
    pdf, copies = _distinct_parts(pdf)
    size = pdf["bytes"].map(len).to_numpy()
    # symbol 0 ends every cell, so no window runs from one cell into the next
    text = np.concatenate([np.append(np.frombuffer(x, np.uint8).astype(np.int64) + 1, 0) for x in pdf["bytes"]])
    begin = np.cumsum(size + 1) - size - 1
    owner = np.repeat(np.arange(len(pdf)), size + 1)
    offset = np.arange(len(text)) - begin[owner]
    order = _sorted_by_anchors(text, begin, pdf["anchor"].to_numpy())
    order = order[offset[order] <= size[owner[order]] - length]
    same = np.ones(max(0, len(order) - 1), bool)
    wide = np.lib.stride_tricks.sliding_window_view((text - 1).astype(np.uint8), 8)
    for at in [*range(0, length - 8, 8), length - 8]:
        w = np.ascontiguousarray(wide[order + at]).view(np.uint64).reshape(-1)
        same &= w[1:] == w[:-1]
    # documents of the block by (id, row), numbered in order
    doc_of, ids = _numbered(pdf["doc_id"].to_numpy(), pdf["row"].to_numpy())
    doc = doc_of[owner[order]]
    start = pdf["start"].to_numpy()[owner[order]] + offset[order]
    rank = np.empty(len(order), np.int64)
    rank[np.lexsort((start, doc))] = np.arange(len(order))
    run = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.repeat(np.minimum.reduceat(rank, run), np.diff(np.append(run, len(order))))
    # equal (doc_id, start) from two overlapping cells are the same window, not a repeat
    by = np.argsort(rank)
    again = np.concatenate([[False], (doc[by][1:] == doc[by][:-1]) & (start[by][1:] == start[by][:-1])])
    canon = np.arange(len(by))
    canon[again] = 0
    canon = np.maximum.accumulate(canon)
    rep = canon[rank] > canon[least]
    spans = _merged(doc[rep], start[rep], length)
    number = spans.pop("doc").to_numpy()
    spans = spans.assign(doc_id=ids[0][number], row=ids[1][number])[["doc_id", "row", "start", "size"]]
    return pd.concat([spans, copies], ignore_index=True)


def _distinct_parts(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The earliest of equal parts, by anchor, and the spans of the others."""
    pdf = pdf.sort_values(["doc_id", "row", "start"], kind="stable")
    copy = pdf.duplicated("bytes")
    own, part = pdf[~copy].sort_values("anchor", kind="stable"), pdf[copy]
    return own, part[["doc_id", "row", "start"]].assign(size=part["bytes"].map(len).astype("int64"))


def _sorted_by_anchors(text: np.ndarray, begin: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Suffixes of the parts that begin at ``begin``, in order within runs of whole anchors."""
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    run = begin[first] // SORTED
    cut = [*begin[first[np.concatenate([[True], run[1:] != run[:-1]])]].tolist(), len(text)]
    return np.concatenate([suffix_array(text[i:j]) + i for i, j in zip(cut, cut[1:])])


def _numbered(doc_id: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Number of each (id, row) in their order, and ids and rows by number."""
    by = np.lexsort((row, doc_id))
    new = np.concatenate([[True], (doc_id[by][1:] != doc_id[by][:-1]) | (row[by][1:] != row[by][:-1])])
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new) - 1
    return number, (doc_id[by][new], row[by][new])


def _shared_parts(pdf: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    """The cells that share a context of length - GRID + 1 bytes around the anchor with another cell of it,
    cut to the windows such contexts can belong to.

    A window that begins o bytes before the anchor contains the context that begins at the multiple of
    GRID at or below o, so equal windows have an equal context.
    """
    data = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
    size = pdf["bytes"].map(len).to_numpy()
    begin = np.cumsum(size) - size
    h = Hashes(data)
    at, inner = begin + pdf["inner"].to_numpy(), length - gram
    first, last = begin + size, begin - 1
    grid = max(1, min(GRID, inner))
    for left in range(0, inner + 1, grid):
        a, b = at - left, at + gram + max(0, inner - left - grid + 1)
        ok = np.flatnonzero((a >= begin) & (b <= begin + size))
        key = pd.DataFrame({"anchor": pdf["anchor"].to_numpy()[ok], "h": h.of(a[ok], b[ok])})
        ok = ok[key.duplicated(keep=False).to_numpy()]
        first[ok] = np.minimum(first[ok], a[ok] - grid + 1)
        last[ok] = np.maximum(last[ok], a[ok])
    first, last = np.maximum(first, begin), np.minimum(last, begin + size - length)
    keep = np.flatnonzero(first <= last)
    lead, end = (first - begin)[keep], (last - begin)[keep] + length
    part = pdf.iloc[keep]
    return part.assign(start=part["start"].to_numpy() + lead,
                       bytes=[x[m:n] for x, m, n in zip(part["bytes"], lead, end)])


def _merged(doc: np.ndarray, start: np.ndarray, length: int) -> pd.DataFrame:
    """Window starts -> spans, windows that touch joined."""
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)])[:len(doc)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[:len(first)] - 1
    return pd.DataFrame({"doc": doc[first], "start": start[first], "size": start[last] + length - start[first]})


def cell_bytes(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Adds the bytes of the wanted cells (anchor, doc_id, row, start, size) and the place of their anchor."""
    asked = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("asked"))
    texts = docs.dropDuplicates(["doc_id", "row"]).join(asked, ["doc_id", "row"])

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                ids, row, texts = (part.column(c) for c in range(3))
                count = pc.list_value_length(part.column(3)).to_numpy()
                anchor, start, size = part.column(3).flatten().flatten()
                cells_, at, ends = [], 0, (pc.add(start, size)).to_pylist()
                starts = start.to_pylist()
                for t, n in zip(texts.to_pylist(), count.tolist()):
                    data = t.encode()
                    cells_ += [data[i:j] for i, j in zip(starts[at:at + n], ends[at:at + n])]
                    at += n
                of = pa.array(np.repeat(np.arange(part.num_rows), count))
                yield pa.RecordBatch.from_arrays(
                    [anchor, ids.take(of), row.take(of), start, pa.array(_anchor_places(cells_, length, gram)),
                     pa.array(cells_, pa.binary())], ["anchor", "doc_id", "row", "start", "inner", "bytes"])
    return texts.select("doc_id", "row", "text", "asked").mapInArrow(
        run, "anchor long, doc_id long, row long, start long, inner long, bytes binary")


def _anchor_places(cells_: list[bytes], length: int, gram: int) -> np.ndarray:
    """Where the anchor of each cell begins: its first window's least gram, leftmost on ties."""
    out, at = [np.zeros(0, np.int64)], np.arange(length - gram + 1)
    for k in range(0, len(cells_), 2048):
        some = cells_[k:k + 2048]
        h = Hashes(np.frombuffer(b"".join(x[:length] for x in some), np.uint8))
        gram_at = np.arange(len(some))[:, None] * length + at
        out.append(np.argmin(h.of(gram_at, gram_at + gram) >> np.uint64(24), axis=1))
    return np.concatenate(out)


def halves(cells_: DataFrame, length: int, core: int) -> tuple[DataFrame, int]:
    """Cells (anchor, doc_id, row, start, inner, bytes) cut in two, and the size of their new cores.

    A window begins at most length - core bytes before the core at ``inner``.  Those that begin at most
    ``mid`` bytes before it share the bytes from the core on, the others those from mid + 1 bytes before it.
    """
    mid = (length - core) // 2
    longer = length - mid
    last = f"length(bytes) - {length}"
    near, far = f"greatest(0L, inner - {mid})", f"least({last}, inner - {mid + 1})"

    def half(lead, end, inner):
        return f"""struct(start + {lead} as start, {inner} - {lead} as inner,
            substring(bytes, cast({lead} + 1 as int), cast({end} + {length} - {lead} as int)) as bytes,
            xxhash64(anchor, {inner} = inner, substring(bytes, cast({inner} + 1 as int), {longer})) as anchor,
            {lead} <= {end} as any)"""
    both = F.explode(F.expr(f"array({half(near, last, 'inner')}, {half('0L', far, f'inner - {mid + 1}')})"))
    return cells_.select("doc_id", "row", both.alias("half")).where("half.any").select(
        "half.anchor", "doc_id", "row", "half.start", "half.inner", "half.bytes"), longer


def block_rows(cells_: DataFrame, total: int, length: int, core: int) -> DataFrame:
    """Repeated spans of cells with ``total`` bytes, sorted in blocks of whole anchors."""
    block = F.pmod(F.xxhash64("anchor"), F.lit(max(1, math.ceil(total / BLOCK_BYTES))))
    return cells_.withColumn("block", block).groupBy("block").applyInPandas(
        lambda pdf: block_spans(pdf, length, core), "doc_id long, row long, start long, size long")


def kinds_of(distinct: DataFrame, size) -> DataFrame:
    """Anchors with more than one distinct cell: anchor, kinds, total (bytes)."""
    return materialise(distinct.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.sum(size).alias("total")).where("kinds > 1"), "anchors")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, row, start, size: spans whose every byte lies in a repeated window (they may overlap)."""
    table = materialise(cell_table(docs, length, gram), "cell_table")
    often = table.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    found = materialise(table.join(often, "anchor", "left_semi"), "cells")
    place = F.struct("doc_id", "row", "start")
    distinct = materialise(found.groupBy("anchor", "cell", "size").agg(
        F.min(place).alias("first"), F.count("*").alias("c")), "distinct_cells")
    spans = found.join(distinct.where("c > 1"), ["anchor", "cell", "size"]).where(place > F.col("first")).select(
        "doc_id", "row", "start", "size")
    kinds = kinds_of(distinct, F.col("size"))
    filled = cell_bytes(docs, distinct.join(kinds.select("anchor"), "anchor").select("anchor", "first.*", "size"), length, gram)
    core = gram
    while True:
        filled = materialise(filled.join(kinds.where(f"kinds > {HOT}").select("anchor", F.lit(True).alias("hot")),
                                         "anchor", "left"), "cell_bytes")
        total, hot = kinds.agg(F.expr(f"sum(total) filter (where kinds <= {HOT})"), F.expr(f"count_if(kinds > {HOT})")).first()
        spans = spans.unionAll(block_rows(filled.where("hot is null"), total or 0, length, core))
        if not hot:
            return spans
        parts, core = halves(filled.where("hot"), length, core)
        key = ["anchor", "inner", "bytes"]
        distinct = materialise(parts.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("c")), "halves")
        spans = spans.unionAll(parts.join(distinct.where("c > 1"), key).where(place > F.col("first")).select(
            "doc_id", "row", "start", F.length("bytes").cast("long").alias("size")))
        kinds = kinds_of(distinct, F.length("bytes"))
        filled = distinct.join(kinds.select("anchor"), "anchor").select("anchor", "first.*", "inner", "bytes")


def remove_spans(docs: DataFrame, spans: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept text, broken characters replaced)."""
    own = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text
    types = [pa.int64()] * 4 + [pa.string()] * 2

    def run(batches):
        for b in batches:
            rows, at = [], 0
            start, size = (c.to_numpy() for c in b.column(2).flatten().flatten())
            count = pc.fill_null(pc.list_value_length(b.column(2)), 0).to_pylist()
            for i, t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), count):
                kept, n, removed, runs = _cut(t.encode(), start[at:at + c], size[at:at + c])
                at += c
                rows.append((i, n, removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)][:len(names)], names)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text
    return docs.join(own, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def _cut(data: bytes, start: np.ndarray, size: np.ndarray) -> tuple[bytes, int, int, int]:
    if not len(start):
        return data, len(data), 0, 0
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate((start + size)[by])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    kept, at = [], 0
    for i, j in zip(start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist()):
        kept.append(data[at:i])
        at = j
    kept.append(data[at:])
    out = b"".join(kept)
    return out, len(data), len(data) - len(out), len(new)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per document, see ``remove_spans``."""
    prepare(docs.sparkSession)
    docs = narrow(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    return remove_spans(docs, materialise(repeated_spans(docs, length, gram), "spans"), with_text)
