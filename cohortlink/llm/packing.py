"""Operator 8: packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's tokens (an end id included) are cut at multiples of the window;
full pieces are windows of their own.  The pieces are dealt to tasks in turn and
packed in shards of about ``SHARD_PIECES`` pieces by multiway differencing: each piece starts as a partial partition of k
windows, the two partial partitions with the largest imbalance are merged,
fullest window of one with emptiest of the other, until one is left.  k starts
at the fewest windows that could hold the shard and rises whenever the fullest
window exceeds the capacity.  Every ``FILLER_EVERY``-th document (by a hash of
its id) has its remainder cut finely; its pieces even out the windows.

Only (id, start, length, checksum) rows are shuffled.  The cut of a document
depends on its own length and id alone, so a retried task makes the same pieces.
The pieces of a document may lie in any sequences; no key gathers rows.

Defined cases: a null or empty text is the end id alone; an empty table packs
to no rows; rows with repeated or null ids are packed each by itself.
"""

from __future__ import annotations

import heapq
import itertools
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm import bpe
from cohortlink.llm.common import narrow, prepare

WINDOW = 2048
END_ID = 1
#: documents a task packs at least (if there are so many), and pieces that are packed together
SHARD_DOCS, SHARD_PIECES = 1024, 3000
FILLER_EVERY = 7
#: the largest and the smallest piece a filler document's remainder is cut into
FILLER_MOST, FILLER_LEAST = 256, 8

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long, sequence_tokens long, padded_tokens long"


def _packed(ids: np.ndarray, ends: list[int]) -> list[bytes]:
    data = ids.astype("<u4").tobytes()
    return [data[4 * a:4 * b] for a, b in zip([0, *ends], ends)]


def cuts(n: int, filler: bool, window: int = WINDOW) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens."""
    out = [window] * (n // window)
    rest = n % window
    while filler and rest > FILLER_LEAST:
        piece = min(FILLER_MOST, 1 << ((rest + 1) // 2).bit_length() - 1)
        out.append(piece)
        rest -= piece
    return out + [rest] * (rest > 0)


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: PIECES (crc32 of its ids as little-endian 32-bit words)."""
    prepare(docs.sparkSession)
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches):
        enc: bpe.StreamEncoder = bpe.loaded(path, "pieces", lambda t: bpe.StreamEncoder(
            t, lambda ids: struct.pack(f"<{len(ids)}I", *ids), b"".join, _packed))
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows: list[tuple] = []
            for doc_id, parts in zip(b.column(0).to_pylist(), enc.batch(b.column(1).to_pylist())):
                data = b"".join([e for part in parts for e in part]) + end
                n, at = len(data) // 4, 0
                filler = zlib.crc32(str(doc_id).encode()) % FILLER_EVERY == 0
                for length in cuts(n, filler, window):
                    rows.append((doc_id, at, length, zlib.crc32(data[4 * at:4 * (at + length)]), n))
                    at += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * len(names))], names)
    return narrow(docs, id_col, text_col).mapInArrow(run, PIECES)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to k - 1) of each piece by multiway largest differencing."""
    n = len(sizes)
    joined = np.arange(n)  # the piece whose window a merged window now follows
    order = np.argsort(-sizes, kind="stable")
    # a partial partition: its non-empty windows, fullest first, each named by one of its pieces
    heap = [(-int(sizes[i]) if k > 1 else 0, r, sizes[i:i + 1], np.array([i])) for r, i in enumerate(order)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, a, ia = heapq.heappop(heap)
        _, _, b, ib = heapq.heappop(heap)
        both = len(a) + len(b) - k
        if both > 0:
            # fullest of a with emptiest of b: the last `both` of a meet the last `both` of b, reversed
            alone = len(b) - both
            joined[ib[alone:][::-1]] = ia[len(a) - both:]
            met = a[len(a) - both:] + b[alone:][::-1]
            sums = np.concatenate([a[:len(a) - both], met, b[:alone]])
            ids = np.concatenate([ia, ib[:alone]])
        else:
            sums, ids = np.concatenate([a, b]), np.concatenate([ia, ib])
        by = np.argsort(-sums, kind="stable")
        sums, ids = sums[by], ids[by]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, made, sums, ids))
        made += 1
    while not np.array_equal(joined, up := joined[joined]):
        joined = up
    return np.unique(joined, return_inverse=True)[1].reshape(-1)


def pack(sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Window of each piece, none over capacity: the window count rises until all fit."""
    k = max(1, math.ceil(int(sizes.sum()) / window))
    while True:
        at = differencing(sizes, k)
        worst = int(np.bincount(at, weights=sizes).max())
        if worst <= window:
            return at
        k += 1


def pack_shard(part: pa.Table, first: int, window: int = WINDOW) -> tuple[pa.Table, int]:
    """Sequences of one shard, numbered from ``first``: full pieces, then the packed remainders; and their number."""
    length = part["length"].to_numpy()
    by = np.argsort(-length, kind="stable")
    sizes = length[by]
    full = int((sizes == window).sum())
    seq = np.arange(len(sizes))
    if full < len(sizes):
        seq[full:] = full + pack(sizes[full:], window)
    again = np.argsort(seq, kind="stable")
    by, seq, sizes = by[again], seq[again], sizes[again]
    upto = np.cumsum(sizes) - sizes
    total = np.bincount(seq, weights=sizes).astype("int64")
    start = np.searchsorted(seq, np.arange(len(total)))
    whole = total[seq]
    new = {"sequence_id": first + seq, "offset": upto - upto[start][seq], "sequence_tokens": whole,
           "padded_tokens": np.where(whole & (whole - 1), window, whole)}
    part = part.take(pa.array(by))
    return pa.table({**{c: part[c] for c in part.schema.names}, **{c: pa.array(v, pa.int64()) for c, v in new.items()}}), len(total)


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every token of every document in exactly one place of one sequence: PACKED.

    ``padded_tokens``: the window, or the sequence's own size at a power of two.
    """
    most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = pieces(docs, path, window, end_id, id_col, text_col)
    # dealt in turn, so no id, null or text gathers anywhere; in a mixed order that a retried task finds again
    own = ["doc_id", "start", "ids_crc32"]
    p = p.repartition(max(1, min(most, math.ceil(docs.count() / SHARD_DOCS)))).sortWithinPartitions(F.xxhash64(*own), *own)

    def run(batches):
        held, rows, first = [], 0, TaskContext.get().partitionId() << 32
        for b in itertools.chain(batches, [None]):
            if b is not None:
                held.append(b)
                rows += b.num_rows
            if rows and (b is None or rows >= SHARD_PIECES):
                out, n = pack_shard(pa.Table.from_batches(held), first, window)
                yield from out.to_batches()
                held, rows, first = [], 0, first + n
    return p.mapInArrow(run, PACKED)
