"""Operator 11: fill-in-middle transformation by content-defined chunk memoization.

A text is cut into three parts at two token borders (a token: a run of ASCII
letters, or one other code point) chosen by a hash of the document's id, and
its parts are put in another order behind markers.  The tokens are counted
without running over shared text twice: a rolling hash of the last ``SPAN``
bytes cuts the text into chunks, so equal passages fall into equal chunks
wherever they stand, and every chunk's boundary summary (tokens, code points,
whether it begins and ends inside a run of letters) is looked up in a cache
whose keys are the chunks' bytes themselves, so a hit is verified by content.
A document's count is the sum over its chunks, less one for every border where
a run goes on; the sums before each chunk locate the two cuts, and only the
chunks that hold a cut are read by position.

The cache belongs to one Python worker and holds at most twice
``CACHE_BYTES``; the texts stay in the JVM, which builds the outputs, so Python
returns three numbers a row.  No shuffle.

Defined cases: a null or empty text has no tokens and stays plain; a null id
hashes as the empty string; repeated rows give the same row each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import narrow, prepare

# fixed values of the output format
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: percent of documents transformed, and of these in suffix-first order
RATE, SPM_RATE = 90, 20

#: bytes the rolling hash looks at (a power of two); a chunk ends where its top bits are zero
SPAN, CUT_BITS = 16, 9
LEAST, MOST = 64, 8192
#: bytes of one step of the rolling hash, and of one generation of the cache
BLOCK, CACHE_BYTES = 1 << 20, 32 << 20


def _gear() -> np.ndarray:
    """256 pseudo-random 32-bit words (a multiplicative generator, so no stored table)."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()
#: letter, other code point; the bytes inside a code point are deleted
KINDS = bytes(97 if chr(b).isalpha() and b < 128 else 98 for b in range(256))
INSIDE = bytes(range(0x80, 0xC0))


def candidates(data: bytes) -> list[int]:
    """Positions where the rolling hash ends a chunk (code point borders only)."""
    out: list[int] = []
    for at in range(0, len(data), BLOCK):
        first = max(0, at - SPAN + 1)
        raw = np.frombuffer(data, np.uint8, min(len(data), at + BLOCK) - first, first)
        h, step = GEAR[raw], 1
        while step < SPAN:  # the hash over 2 * step bytes from two hashes over step bytes
            h[step:] += h[:-step] << np.uint32(step)
            step *= 2
        ends = np.flatnonzero(h[at - first:] >> np.uint32(32 - CUT_BITS) == 0) + at + 1
        out += ends.tolist()
    return [p for p in out if p < len(data) and data[p] & 0xC0 != 0x80]


def chunks(data: bytes) -> list[bytes]:
    """Content-defined chunks of a UTF-8 text, LEAST to MOST bytes long (the last may be shorter)."""
    out: list[bytes] = []
    at = 0
    for p in [*candidates(data), len(data)]:
        while p - at > MOST:
            cut = at + MOST
            while data[cut] & 0xC0 == 0x80:
                cut -= 1
            out.append(data[at:cut])
            at = cut
        if p - at >= LEAST or p == len(data) > at:
            out.append(data[at:p])
            at = p
    return out


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Boundary summary: tokens seen alone, code points, begins with a letter, ends with a letter."""
    kinds = chunk.translate(KINDS, INSIDE)
    begins = kinds.startswith(b"a")
    return kinds.count(b"b") + kinds.count(b"ba") + begins, len(kinds), begins, kinds.endswith(b"a")


class SummaryCache:
    """Chunk bytes to summary, in two generations: the older one is dropped when the newer is full."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.new, self.old = most, 0, {}, {}
        self.hits = self.misses = 0

    def get(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.new.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            self.misses += 1
            found = summary(chunk)
        else:
            self.hits += 1
        if self.held + len(chunk) > self.most:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[chunk] = found
        self.held += len(chunk)
        return found


class Counted:
    """One text's chunks with the tokens and code points before each."""

    def __init__(self, text: str, cache: SummaryCache):
        self.parts = chunks(text.encode())
        found = [cache.get(c) for c in self.parts]
        # a run of letters across a border counts once
        self.joined = [b and e for (_, _, b, _), (_, _, _, e) in zip(found, [(0, 0, False, False), *found])]
        self.tokens = list(accumulate((f[0] - j for f, j in zip(found, self.joined)), initial=0))
        self.points = list(accumulate((f[1] for f in found), initial=0))
        self.n, self.length = self.tokens[-1], self.points[-1]

    def position(self, token: int) -> int:
        """Code points before the given token (``n``: the whole text)."""
        if token >= self.n:
            return self.length
        c = bisect.bisect_right(self.tokens, token) - 1
        kinds = np.frombuffer(self.parts[c].translate(KINDS, INSIDE), np.uint8)
        starts = kinds == 98
        starts[1:] |= starts[:-1]
        starts[0] = True
        return self.points[c] + int(np.flatnonzero(starts)[token - self.tokens[c] + self.joined[c]])


def cuts(text: str, h1: int, h2: int, cache: SummaryCache) -> tuple[int, int, int]:
    """Tokens, and the code points before the end of the prefix and of the middle."""
    counted = Counted(text, cache)
    a, b = sorted((h1 % (counted.n + 1), h2 % (counted.n + 1)))
    return counted.n, counted.position(a), counted.position(b)


_CACHE: list[SummaryCache] = []
_STRUCT = pa.struct([("n", pa.int64()), ("prefix_end", pa.int64()), ("middle_end", pa.int64())])


def cut_points(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    if not _CACHE:
        _CACHE.append(SummaryCache())  # one a worker, it lives on between tasks
    rows = [cuts(t, a, b, _CACHE[0]) for t, a, b in zip(text.to_pylist(), h1.to_pylist(), h2.to_pylist())]
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_STRUCT))


def _hash(k: int) -> Column:
    """The k-th 8-digit group of sha256('1:' + decimal id)."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain), text and output."""
    prepare(docs.sparkSession)
    d = narrow(docs, id_col, text_col)
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(m))
    form = (F.when((F.col("text") == "") | marked | (_hash(3) % 100 >= rate), PLAIN)
            .when(_hash(4) % 100 < spm_rate, SPM).otherwise(PSM))
    points = F.arrow_udf(cut_points, "struct<n: long, prefix_end: long, middle_end: long>")
    d = d.withColumn("form", form).withColumn("cut", points("text", _hash(1), _hash(2)))
    a, b = F.col("cut.prefix_end").cast("int"), F.col("cut.middle_end").cast("int")
    prefix, middle = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b - a)
    suffix = F.substring("text", b + 1, F.length("text"))
    whole = F.col("form") != PLAIN
    output = (F.when(F.col("form") == PSM, F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .when(F.col("form") == SPM, F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.col("text")))
    return d.select("doc_id", F.col("cut.n").alias("n"), "form",
                    F.when(whole, F.col("cut.prefix_end")).alias("prefix_chars"),
                    F.when(whole, F.col("cut.middle_end") - F.col("cut.prefix_end")).alias("middle_chars"),
                    "text", output.alias("output"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text behind an output: a transformed text holds no marker of its own, so the three markers split it."""
    parts = F.split(output, f"{re.escape(PREFIX)}|{re.escape(SUFFIX)}|{re.escape(MIDDLE)}")
    return (F.when(F.col(form) == PSM, F.concat(parts[1], parts[3], parts[2]))
            .when(F.col(form) == SPM, F.concat(parts[2], parts[3], parts[1]))
            .otherwise(F.col(output)))


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` with the texts replaced by their digests, and the digest of the text rebuilt from the output."""
    t = transform(docs)
    return t.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                    F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as s,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u
  from documents
), h as (
  select *, len(u) as n, cast('0x' || substr(s, 1, 8) as bigint) as h1, cast('0x' || substr(s, 9, 8) as bigint) as h2,
         cast('0x' || substr(s, 17, 8) as bigint) as h3, cast('0x' || substr(s, 25, 8) as bigint) as h4
  from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= {RATE}
              then 'plain' when h4 % 100 < {SPM_RATE} then 'spm' else 'psm' end as form
  from h
), p as (
  select doc_id, n, form, t, coalesce(array_to_string(u[1:a], ''), '') as prefix,
         coalesce(array_to_string(u[a + 1:b], ''), '') as middle, coalesce(array_to_string(u[b + 1:n], ''), '') as suffix
  from c
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else t end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""
