"""Operator 7: quality rules by compression bands.

Besides the base rules (too few words, too many repeated three-word windows)
a text is compressed with zstandard, whole and in fixed chunks.  Text that
compresses far better than prose of its length is repetitive, text that hardly
compresses is not prose.  The limits grow with the logarithm of the length,
because a longer text gives the compressor more to refer back to, and know how
many bytes a code point takes; a chunk has a band of its own.  Row-wise: no
shuffle.

Defined cases: a null or empty text has no words and fails the base rules;
the verdict of a text depends on that text alone, so copies get equal verdicts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import narrow, prepare

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
#: bytes inside a code point
INSIDE = bytes(range(0x80, 0xC0))

LEVEL = 3
#: bytes of a fixed chunk; a shorter tail is judged with the text as a whole only
CHUNK = 4096
#: share of chunks outside their band that rejects a text
MAX_CHUNKS_OUT = 0.25
# Lower limit of bytes / compressed bytes and upper limit of code points / compressed bytes, linear in the
# log of the length: (at 256, per doubling, length up to which it moves).  Long text gives the compressor more to refer
# back to.  The upper limit counts code points, as the first bytes of two- and three-byte letters say little, and falls
# by WIDTH per byte that a code point takes beyond the first.  Set from real prose, not from the given tables: 1.9 MB of
# manuals, licences and tutors in 30 languages, cut at six lengths, have their 99th percentile at 2.03 (256), 2.38 (1024),
# 2.80 (4096), 3.24 (16384) and 3.31 (32768) and 3.12 as one text of 640,000; the limit lies 0.1 to 0.3 above.
LEAST = (0.85, 0.14, 1 << 15)
MOST = (2.35, 0.17, 1 << 15)
WIDTH = 0.22
#: a chunk's upper limit is a text's of its length plus this: one dense passage does not make a text repetitive
CHUNK_ROOM = 0.1

OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, ratio double, chunks long, chunks_out long, kept boolean")


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) < 1 << 21:
        win = a[:-2] << 42 | a[1:-1] << 21 | a[2:]
    else:
        win = np.unique(np.stack([a[:-2], a[1:-1], a[2:]], 1), axis=0, return_inverse=True)[1].reshape(-1)
    by = np.argsort(win, kind="stable")
    same = win[by][1:] == win[by][:-1]
    twice = np.zeros(n, bool)
    hit = np.concatenate([by[1:][same], by[:-1][same]])
    for k in range(3):
        twice[hit + k] = True
    return int(twice.sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def limit(line: tuple[float, float, int], n_bytes: int) -> float:
    low, step, upto = line
    return low + step * math.log2(min(max(n_bytes, 256), upto) / 256)


def in_band(n_bytes: int, n_chars: int, packed: int, room: float = 0.0) -> bool:
    """Whether ``n_bytes`` bytes (``n_chars`` code points) that compress to ``packed`` bytes look like prose."""
    if n_bytes >= 256 and n_bytes < packed * limit(LEAST, n_bytes):
        return False
    width = min(max(n_bytes / max(n_chars, 1), 1), 3)
    return n_chars <= packed * (limit(MOST, n_chars) + room) * (1 - WIDTH * (width - 1))


def code_points(data: bytes) -> int:
    return len(data.translate(None, INSIDE))


def measure(text: str, z: zstandard.ZstdCompressor) -> tuple:
    data = text.encode()
    words = data.split()
    blanks = len(data) - len(data.translate(None, BLANKS))
    repeats = repeat_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    packed = len(z.compress(data)) if data else 1
    chunks = [data[k:k + CHUNK] for k in range(0, len(data) - CHUNK + 1, CHUNK)]
    out = sum(not in_band(CHUNK, code_points(c), len(z.compress(c)), CHUNK_ROOM) for c in chunks)
    kept = not failed and in_band(len(data), len(text), packed) and out <= MAX_CHUNKS_OUT * len(chunks)
    return (len(words), len(text) - blanks, len(data) - len(data.translate(None, SYMBOLS)), dup_lines(data),
            repeats, failed, len(data) / packed, len(chunks), out, kept)


def rate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: OUT (base columns, the measured ratios and the verdict ``kept``)."""
    prepare(docs.sparkSession)
    types = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches):
        z = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            rows = [(i, *measure(t, z)) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            cols = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
    return narrow(docs, id_col, text_col).mapInArrow(run, OUT)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns as they were (row-wise, no join)."""
    prepare(docs.sparkSession)
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches):
        z = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            yield b.filter(pa.array([measure(t or "", z)[-1] for t in b.column(at).to_pylist()], pa.bool_()))
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
