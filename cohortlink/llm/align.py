"""Operator 12: cross-tokenizer alignment by pointer jumping.

Two tokenizers, A (byte-level BPE) and B (pieces), split the same bytes.  The
tokens of a whole batch of texts lie on one byte axis.  Every token points to
the farthest-right token that overlaps it: the other side's token over its last
byte, or nothing if both end together.  Doubling the successors (numpy, all
tokens at once) converges to the terminal token of each component, the A token
where both sides end; it labels the smallest pieces of text that both
tokenizers cut alike.  The segments between neighbouring token ends are the
links, one overlapping pair of token occurrences each.

How many documents hold a linked pair of ids is a corpus-wide count.  Tasks
write their documents in blocks: per document the numbers of its distinct pairs
within the block and how often each occurs, per block its distinct pairs with
document counts.  Only block pairs are counted over the corpus and sent back
to their blocks, so a pair that all documents share is one row a block, not one
a document; a block is closed at ``BLOCK_DOCS`` documents or ``BLOCK_PAIRS``
(document, pair) rows, which bounds what a task holds.  Nothing is broadcast.

Long texts are encoded in parts cut at single blanks: no piece of either
tokenizer reaches across such a blank, so the ids are those of the whole text.

Defined cases: a null or empty text, or one whose joined token bytes on either
side differ from blank + text (U+2581 in the text, for instance) has no tokens:
zeros and an empty ``groups_sha256``; repeated rows count as documents each; a
null id keeps its row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.bpe import byte_alphabet, tokenizer_path
from cohortlink.llm.common import materialise, narrow, prepare

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_DOCS, BLOCK_PAIRS = 4096, 1 << 20
#: longer texts are encoded in parts of about so many characters
LONG = 1 << 16
#: ids are below 2 ** ID_BITS; a pair is one long, and a batch has below 2 ** 15 texts
ID_BITS = 24
PAIR = (1 << 2 * ID_BITS) - 1
# fixed value: the byte-level tokenizer's word pattern
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANK = re.compile(r"(?<! ) (?=\S)")


class Tokenizers:
    """Both tokenizers of one worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.a = _by_rank(spec, a_bytes) or _by_library(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(a_bytes.get(i, b"")) for i in range(max(a_bytes) + 1)])
        self.b_len = np.array([len(p) for p in self.b_bytes])
        # cuts at single blanks are only exact if no piece goes on into a blank
        self.whole = any(b" " in p.lstrip(b" ") for p in self.b_bytes)
        self.a_names, self.b_names = _names(len(self.a_len), ",|"), _names(len(self.b_len), [",", ";", ""])

    def _piece(self, i: int) -> bytes:
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def parts(self, text: str) -> list[str]:
        """The text cut at blanks about every LONG characters; each part is encoded behind a blank."""
        out, at = [], 0
        while len(text) - at > LONG and not self.whole and (cut := BLANK.search(text, at + LONG)):
            out.append(text[at:cut.start()])
            at = cut.end()
        return out + [text[at:]] if text else []

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """A and B ids of each text, none where B's bytes are not those of blank + text (A's always are)."""
        split = [self.parts(t) for t in texts]
        b_ids = iter(self.b.encode([p for parts in split for p in parts], num_threads=1))
        out = []
        for parts in split:
            a, b = [], []
            for p in parts:
                found = next(b_ids)
                b += found if b"".join(map(self.b_bytes.__getitem__, found)) == (" " + p).encode() else [None]
            if b and None not in b:
                for p in parts:
                    a += self.a(" " + p)
            out.append((a, b if a else []))
        return out


def _by_rank(spec: dict, a_bytes: dict[int, bytes]):
    """A's encoder, if merges make ids in order: then the lowest id is the first merge, and the file's own
    vocabulary serves as a table of ranks, whose encoder returns nothing but ids."""
    pre, merges = spec["pre_tokenizer"] or {}, spec["model"]["merges"]
    vocab = spec["model"]["vocab"]
    pair = [m if isinstance(m, list) else m.split(" ") for m in merges]
    if (spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True)
            or pre.get("add_prefix_space") or any(vocab["".join(m)] != 256 + i for i, m in enumerate(pair))):
        return None
    import tiktoken

    return tiktoken.Encoding(A_FILE, pat_str=WORDS, mergeable_ranks={t: i for i, t in a_bytes.items()},
                             special_tokens={}).encode_ordinary


def _by_library(a_path: str):
    import tokenizers

    a = tokenizers.Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return lambda text: a.encode(text, add_special_tokens=False).ids


def _names(n: int, ends) -> list[np.ndarray]:
    return [np.array([f"{i}{end}" for i in range(n)], dtype=object) for end in ends]


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For every token (A tokens, then B tokens; ends ascending, the last ends equal) the A token that
    ends its component: successors to the farthest-right overlapping token, doubled until they rest."""
    over_a = np.searchsorted(b_end, a_end)   # the B token over an A token's last byte
    over_b = np.searchsorted(a_end, b_end)
    here = np.arange(len(a_end))
    succ = np.concatenate([np.where(b_end[over_a] > a_end, len(a_end) + over_a, here), over_b]) if len(a_end) else here
    while not np.array_equal(succ, farther := succ[succ]):
        succ = farther
    return succ


class Aligned(NamedTuple):
    """A batch of texts on one byte axis.  ``*_doc`` is each token's text, ``*_group`` its component
    (numbered over the batch); ``link_*`` name the tokens of each overlapping pair."""
    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align_batch(tok: Tokenizers, texts: list[str]) -> Aligned:
    coded = tok.encode(texts)
    a, b = (np.fromiter(itertools.chain.from_iterable(c[k] for c in coded), np.int64) for k in (0, 1))
    a_end, b_end = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
    last = terminals(a_end, b_end)
    group = np.cumsum(last[:len(a)] == np.arange(len(a))) - 1   # of a terminal: components are in order
    ends = np.sort(np.concatenate([a_end, b_end]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    docs = np.arange(len(texts))
    return Aligned(a, b, a_end, b_end, np.repeat(docs, [len(c[0]) for c in coded]),
                   np.repeat(docs, [len(c[1]) for c in coded]), group[last[:len(a)]], group[last[len(a):]],
                   np.searchsorted(a_end, ends), np.searchsorted(b_end, ends))


def group_texts(tok: Tokenizers, x: Aligned, n: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each of the batch's ``n`` texts."""
    if not len(x.a):
        return [""] * n
    groups = int(x.a_group[-1]) + 1
    a_upto = np.cumsum(np.bincount(x.a_group, minlength=groups))
    b_upto = np.cumsum(np.bincount(x.b_group, minlength=groups))
    out = np.empty(len(x.a) + len(x.b), dtype=object)
    # an A token stands behind the B tokens of earlier groups, a B token behind the A tokens of its own
    a_at = np.arange(len(x.a)) + np.concatenate([[0], b_upto])[x.a_group]
    b_at = np.arange(len(x.b)) + a_upto[x.b_group]
    a_last = np.append(x.a_group[1:] != x.a_group[:-1], True)
    b_last = np.append(x.b_group[1:] != x.b_group[:-1], True)
    b_final = np.append(x.b_doc[1:] != x.b_doc[:-1], True)
    for names, ids, at, kind in ((tok.a_names, x.a, a_at, a_last.astype(int)),
                                 (tok.b_names, x.b, b_at, b_last.astype(int) + b_final)):
        for k, name in enumerate(names):
            out[at[kind == k]] = name[ids[kind == k]]
    size = np.bincount(x.a_doc, minlength=n) + np.bincount(x.b_doc, minlength=n)
    upto = np.cumsum(size)
    return ["".join(out[end - k:end].tolist()) for end, k in zip(upto.tolist(), size.tolist())]


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def loaded(a_path: str, b_path: str) -> Tokenizers:
    """One pair of tokenizers per worker process."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Tokenizers(a_path, b_path)
    return _LOADED[a_path, b_path]


PARTS = ("doc boolean, block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, pair_at binary, pair_n binary, pairs array<long>, pair_docs array<long>")
_PARTS = pa.schema([("doc", pa.bool_()), ("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("groups_sha256", pa.string()), ("pair_at", pa.binary()), ("pair_n", pa.binary()),
                    ("pairs", pa.list_(pa.int64())), ("pair_docs", pa.list_(pa.int64()))])


class Block:
    """Documents of one task whose pairs are numbered together."""

    def __init__(self, name: str):
        self.name, self.rows, self.pairs, self.times, self.sizes, self.held = name, [], [], [], [], 0

    def add(self, rows: list[tuple], size: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows += rows
        self.sizes.append(size)
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)

    def close(self) -> pa.RecordBatch:
        pairs, number, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        # frequent pairs get small numbers, which compress well
        order = np.argsort(-docs, kind="stable")
        rank = np.empty(len(order), dtype="<i4")
        rank[order] = np.arange(len(order), dtype="<i4")
        at, times = rank[number.reshape(-1)], np.concatenate(self.times).astype("<i4")
        upto = np.cumsum(np.concatenate(self.sizes)).tolist()
        spans = list(zip([0, *upto], upto))
        n = len(self.rows)
        columns = [[True] * n + [False], [self.name] * (n + 1),
                   *([*c, None] for c in (zip(*self.rows) if n else [()] * 6)),
                   [at[i:j].tobytes() for i, j in spans] + [None], [times[i:j].tobytes() for i, j in spans] + [None],
                   [None] * n + [pairs[order]], [None] * n + [docs[order]]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS)


def blocks(docs: DataFrame, a_path: str, b_path: str, block_docs: int = BLOCK_DOCS,
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """PARTS: one row per document (``doc``) and one per block.  A block's name is drawn anew in every
    attempt of a task, so the rows are only of use once written."""
    def run(batches):
        import uuid

        tok = loaded(a_path, b_path)
        block = Block(uuid.uuid4().hex)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = len(texts)
            x = align_batch(tok, texts)
            link_doc = x.a_doc[x.link_a]
            # distinct pairs of each document and their numbers of links, by one sort of (document, pair)
            key = np.sort(link_doc << 2 * ID_BITS | x.a[x.link_a] << ID_BITS | x.b[x.link_b])
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.array([], int)
            times = np.diff(np.append(first, len(key)))
            key = key[first]
            shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(tok, x, n)]
            new_group = np.append(x.a_group[1:] != x.a_group[:-1], True) if len(x.a) else np.array([], bool)
            rows = list(zip(batch.column(0).to_pylist(), np.bincount(x.a_doc, minlength=n).tolist(),
                            np.bincount(x.b_doc, minlength=n).tolist(),
                            np.bincount(x.a_doc[new_group], minlength=n).tolist(),
                            np.bincount(link_doc, minlength=n).tolist(), shas))
            block.add(rows, np.bincount(key >> 2 * ID_BITS, minlength=n), key & PAIR, times)
            if len(block.rows) >= block_docs or block.held >= block_pairs:
                yield block.close()
                block = Block(uuid.uuid4().hex)
        if block.rows:
            yield block.close()
    return narrow(docs).mapInArrow(run, PARTS)


def _block_pairs(parts: DataFrame) -> DataFrame:
    return parts.where("not doc").select("block", F.arrays_zip("pairs", "pair_docs").alias("z")).select(
        "block", F.posexplode("z").alias("at", "z")).select(
        "block", "at", F.col("z.pairs").alias("pair"), F.col("z.pair_docs").alias("pair_docs"))


def _counts(parts: DataFrame) -> DataFrame:
    """pair, n_docs, best: documents that hold the pair linked; best: none of its A id's pairs has more."""
    n = _block_pairs(parts).groupBy("pair").agg(F.sum("pair_docs").alias("n_docs"))
    n = materialise(n.withColumn("a", F.shiftright("pair", ID_BITS)), "pair-counts")
    most = n.groupBy("a").agg(F.max("n_docs").alias("most"))
    return n.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """a_id, b_id, n_docs, best: the corpus-wide table of linked ids."""
    prepare(docs.sparkSession)
    parts = materialise(blocks(docs, a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)), "aligned")
    return _counts(parts).select(F.shiftright("pair", ID_BITS).alias("a_id"),
                                 F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("b_id"), "n_docs", "best")


SCORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
_SCORED = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SCORED.split(", ")])


def _score_block(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with its pairs' corpus-wide counts."""
    at = pairs["at"].to_numpy()
    n_docs, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    n_docs[at], best[at] = pairs["n_docs"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for numbers, times in zip(docs["pair_at"].to_pylist(), docs["pair_n"].to_pylist()):
        k, t = np.frombuffer(numbers, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
        n_best.append(int(best[k] @ t))
        count_sum.append(int(n_docs[k] @ t))
    values = {**{c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")},
              "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table([values[f.name] for f in _SCORED], schema=_SCORED)


def score(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
          block_docs: int = BLOCK_DOCS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """SCORED, one row per document: its alignment, and how common its linked pairs of ids are."""
    prepare(docs.sparkSession)
    parts = materialise(blocks(docs, a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE),
                               block_docs, block_pairs), "aligned")
    back = _block_pairs(parts).select("block", "at", "pair").join(_counts(parts), "pair").select(
        "block", "at", "n_docs", "best")
    rows = parts.where("doc").select(F.col("block").alias("doc_block"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                                     "pair_at", "pair_n")
    return rows.groupBy("doc_block").cogroup(back.groupBy("block")).applyInArrow(_score_block, SCORED)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, groups: array of (start and end byte in the text behind one blank, A ids, B ids)."""
    prepare(docs.sparkSession)
    a_path, b_path = a_path or tokenizer_path(A_FILE), b_path or tokenizer_path(B_FILE)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())),
                               ("b", pa.list_(pa.int32()))]))

    def run(batches):
        tok = loaded(a_path, b_path)
        for batch in batches:
            x = align_batch(tok, batch.column(1).to_pylist())
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            ids = np.arange(int(x.a_group[-1]) + 1 if len(x.a) else 0)
            a_upto, b_upto = np.searchsorted(x.a_group, ids, "right"), np.searchsorted(x.b_group, ids, "right")
            start, doc = 0, -1
            for g in ids.tolist():
                i, j = (a_upto[g - 1], b_upto[g - 1]) if g else (0, 0)
                if x.a_doc[i] != doc:
                    doc, zero = int(x.a_doc[i]), start
                end = int(x.a_end[a_upto[g] - 1])
                out[doc].append({"start": start - zero, "end": end - zero, "a": x.a[i:a_upto[g]].tolist(),
                                 "b": x.b[j:b_upto[g]].tolist()})
                start = end
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "groups"])
    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>")
