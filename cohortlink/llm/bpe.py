"""Operator 10: BPE encoding and decoding as a bounded-lookahead streaming transducer.

``MergeTable`` reads a public tokenizer file (BPE merge list, optional
end-of-word suffix, byte-level alphabet).  ``sufficient_lookahead`` computes,
from the merge list alone, a number of characters L such that a token that
ends L characters or more before the end of what has been read is the same
whatever text follows.  ``StreamEncoder`` reads text piece by piece and emits
tokens as soon as they are stable in that sense, so its buffer is bounded by
L plus one block and not by the length of a word or text.  ``StreamDecoder``
turns ids back to text one id at a time (byte to text state machine).

Why the lookahead suffices: run the merge list on ``w + x`` and ``w + y``.
The leftmost place where both runs differ starts at the end of ``w`` and only
moves left when a rule (u, v) joins the last common token u with a token v
that begins at that place; it then moves by len(u).  The next rule that moves
it has a later rank and a right part that begins with u.  So the total move is
at most the largest sum of len(u) over chains of rules with rising rank in
which each right part begins with the left part before it.  That needs a
list in which every symbol is made before it is used, which is checked.

Defined cases: a null text is the empty text (no tokens, digests of the empty
string); strings of special tokens in a text become their ids, as the
tokenizers library does by default; ties and repeated rows are encoded alike.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortlink.llm.common import narrow, prepare

#: characters of text taken at a time
PIECE = 1 << 16
#: characters of text whose words are looked up together
BATCH = 1 << 21
#: entries of each of the two generations of the encoder's memos
MEMO = 400_000
#: white-space-free pieces up to this length are encoded (and remembered) whole
SHORT = 64

_BITS = 24
_ID, _NONE = (1 << _BITS) - 1, 1 << 62
_NO_RANK = 1 << 38

_ODD = re.compile("[\x1c-\x1fΣ]")
_SPACE = re.compile(r"[ \t\n\r](?=[!-~])")
#: between two of these characters neither composition nor case mapping interacts
_PLAIN = r"[A-Za-z0-9Ѐ-ҁҊ-ԯぁ-ゖァ-ヺ一-鿿가-힣]"
_INNER = re.compile(_PLAIN + "{16}(?=" + _PLAIN + ")")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others take 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Vocabulary, ranked merges and text rules of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("unk_token") \
                or model.get("ignore_merges") or spec.get("post_processor"):
            raise ValueError(f"{path}: only plain BPE files are supported")
        norm = spec.get("normalizer") or {"normalizers": []}
        kinds = [(n["type"], n.get("content")) for n in norm.get("normalizers", [norm])]
        if kinds != [("NFC", None), ("Replace", " "), ("Lowercase", None)]:
            raise ValueError(f"{path}: unsupported normalizer {kinds}")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError(f"{path}: unsupported pre-tokenizer")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.tokens = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.joined = spec.get("decoder") is None
        self.rules = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: pair of ids -> rank of its merge, with the id it makes in the low bits
        self.ranks: dict[tuple[int, int], int] = {
            (self.vocab[u], self.vocab[v]): k << _BITS | self.vocab[u + v] for k, (u, v) in enumerate(self.rules)}
        self.alphabet = byte_alphabet()
        self.byte_id = [self.vocab[c] for c in self.alphabet]
        self.last_id = [self.vocab[c + self.suffix] for c in self.alphabet]
        pairs = sorted((a << 24 | b, r >> _BITS) for (a, b), r in self.ranks.items())
        self._keys, self._rank_of = (np.array(c, np.int64) for c in zip(*pairs))
        self._made = np.array([self.vocab[u + v] for u, v in self.rules], np.int64)
        self._bytes, self._lasts = np.array(self.byte_id, np.int64), np.array(self.last_id, np.int64)
        self.lookahead = sufficient_lookahead(self.rules, self.suffix)

    def encode_bytes(self, data: bytes, last: bool) -> list[int]:
        """BPE of one word's bytes; ``last``: the word ends here, so its last byte takes the suffix."""
        ids = [self.byte_id[b] for b in data]
        if last and ids:
            ids[-1] = self.last_id[data[-1]]
        return self._merge(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge(self, ids: list[int]) -> list[int]:
        get, none = self.ranks.get, _NONE
        rank = [get(p, none) for p in zip(ids, ids[1:])]
        while rank:
            best = min(rank)
            if best == none:
                break
            k = rank.index(best)
            ids[k] = made = best & _ID
            del ids[k + 1], rank[k]
            if k:
                rank[k - 1] = get((ids[k - 1], made), none)
            if k < len(rank):
                rank[k] = get((made, ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a queue of pairs, lowest rank and leftmost first."""
        n, get = len(ids), self.ranks.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(r, k, p) for k, p in enumerate(zip(ids, ids[1:])) if (r := get(p)) is not None]
        heapq.heapify(queue)
        while queue:
            best, k, pair = heapq.heappop(queue)
            made, j = best & _ID, after[k]
            if ids[k] < 0 or j < 0 or (ids[k], ids[j]) != pair:
                continue
            ids[k], ids[j] = made, -1
            after[k] = after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for a in (before[k], k):
                if a >= 0 and after[a] >= 0 and (r := get(p := (ids[a], ids[after[a]]))) is not None:
                    heapq.heappush(queue, (r, a, p))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """BPE of many short words at once: all their ids in a row, and where each word's ids end.

        Every round joins, in each word that still has a pair to join, the leftmost
        pair of lowest rank; words without one leave the working set.
        """
        data = [w.encode() for w in words]
        size = np.fromiter(map(len, data), np.int64, len(data))
        flat = np.frombuffer(b"".join(data), np.uint8)
        ids, ends = self._bytes[flat], np.cumsum(size)
        ids[ends - 1] = self._lasts[flat[ends - 1]]
        rank = np.full(len(ids), _NO_RANK, np.int64)
        rank[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[ends - 1] = _NO_RANK
        starts, own = ends - size, np.arange(len(words))
        done_ids, done_at, n_ids = [], [], np.zeros(len(words), np.int64)
        while len(own):
            n = len(ids)
            best = np.minimum.reduceat(rank << 24 | np.arange(n), starts)
            live = best < _NO_RANK << 24
            width = np.diff(starts, append=n)
            if not live.all():
                rest = np.repeat(live, width)
                n_ids[own[~live]] = width[~live]
                done_ids.append(ids[~rest])
                done_at.append(own[~live])
                ids, rank = ids[rest], rank[rest]
                gone = np.cumsum(np.where(live, 0, width))
                best = best[live] - gone[live]  # the low bits are places, which move left
                own, width = own[live], width[live]
                starts = np.cumsum(width) - width
                if not len(own):
                    break
            at = best & ((1 << 24) - 1)
            ids[at] = self._made[best >> 24]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            last = at + 1 == starts + width - 1
            ids, rank = ids[keep], rank[keep]
            shift = np.arange(len(own))
            at, starts, width = at - shift, starts - shift, width - 1
            rank[at[last]] = _NO_RANK
            right, left = at[~last], at[at > starts]
            rank[right] = self._ranks(ids[right], ids[right + 1])
            rank[left - 1] = self._ranks(ids[left - 1], ids[left])
        # words ended in different rounds: back to the order asked for
        order = np.concatenate(done_at) if done_at else own
        length = n_ids[order]
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(length) - length
        end = np.cumsum(n_ids)
        place = np.repeat(begin - (end - n_ids), n_ids) + np.arange(int(n_ids.sum()))
        return np.concatenate([*done_ids, ids[:0]])[place], end.tolist()

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 24 | b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._rank_of[at], _NO_RANK)

    def normalise(self, text: str) -> str:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # str.lower() has a rule for a final sigma; the library maps each character by itself
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def sufficient_lookahead(rules: list[tuple[str, str]], suffix: str = "") -> int:
    """Characters after which a token no longer depends on the text that follows."""
    made: set[str] = {c for u, v in rules for t in (u, v) for c in (t.removesuffix(suffix) if suffix else t)}
    made |= {c + suffix for c in made}
    reach: dict[str, int] = {}
    for u, v in rules:
        if u not in made or v not in made:
            raise ValueError(f"merge ({u}, {v}) uses a symbol before it is made")
        made.add(u + v)
        moved = len(u) + max((reach.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0)
        reach[u] = max(reach.get(u, 0), moved)
    longest = max((len(u) + len(v.removesuffix(suffix) if suffix else v) for u, v in rules), default=1)
    return max(reach.values(), default=0) + longest


class WordTransducer:
    """Encodes one (possibly endless) word fed in pieces; holds back what is not yet stable."""

    def __init__(self, table: MergeTable):
        self.table, self.held, self.block = table, b"", max(256, table.lookahead)

    def feed(self, data: bytes) -> Iterator[int]:
        for k in range(0, len(data), self.block):
            self.held += data[k:k + self.block]
            # one more byte is held back: the last byte of a word is another symbol
            if len(self.held) <= self.table.lookahead + self.block:
                continue
            done = 0
            for i in self.table.encode_bytes(self.held, last=False):
                end = done + len(self.table.tokens[i])
                if end > len(self.held) - 1 - self.table.lookahead:
                    break
                done = end
                yield i
            self.held = self.held[done:]

    def finish(self) -> Iterator[int]:
        yield from self.table.encode_bytes(self.held, last=True)
        self.held = b""


class Memo(dict):
    """Encodings of recent words, in two generations of bounded size."""

    def __init__(self, make: Callable[[str], object], limit: int = MEMO):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def put_all(self, values: dict) -> None:
        if len(self) + len(values) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(values)

    def unknown(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` in neither generation; the others move to the young one."""
        keys = keys.difference(self)
        again = keys & self.old.keys()
        self.put_all({k: self.old[k] for k in again})
        return list(keys - again)


class StreamEncoder:
    """Text in pieces -> rendered tokens, emitted once stable.

    ``render`` turns a list of ids to what the caller collects (bytes, text,
    counts), ``join`` puts several of them together, ``render_all`` renders many
    words given in a row with their ends.  Results come in text order.  The memo outlives a document.
    """

    def __init__(self, table: MergeTable, render: Callable[[list[int]], object], join: Callable[[list], object],
                 render_all: Callable[[np.ndarray, list[int]], list] | None = None):
        self.table, self.render, self.join = table, render, join
        self.render_all = render_all or self._render_each
        self.words: Memo = Memo(lambda w: render(table.encode_bytes(w.encode(), True)))
        self.memo: Memo = Memo(self._chunk)
        self.raw, self.open = "", None

    def _chunk(self, chunk: str):
        """A normalised white-space-free piece."""
        return self.join([self.words[w] if len(w) <= SHORT else self._long(w)
                          for w in self.table.pattern.findall(chunk)])

    def _long(self, word: str):
        t = WordTransducer(self.table)
        return self.render([*t.feed(word.encode()), *t.finish()])

    def learn(self, chunks: set[str]) -> None:
        """Encodes the chunks that are not remembered, their short words all at once."""
        find = self.table.pattern.findall
        single, several = [], []
        for c in self.memo.unknown(chunks):
            if c.isalpha() and len(c) <= SHORT:
                single.append(c)
            else:
                several.append((c, [c[:-1], c[-1]] if c[-1] in ".," and c[:-1].isalpha() else find(c)))
        parts = {w for _, ws in several for w in ws if len(w) <= SHORT}
        words = self.words.unknown(parts)
        new = list({*single, *words})
        known: dict = {}
        if new:
            ids, ends = self.table.encode_words(new)
            known = dict(zip(new, self.render_all(ids, ends)))
        found = {c: known[c] for c in single}
        self.words.put_all({w: known[w] for w in words})
        get, join = self.words.__getitem__, self.join
        for c, ws in several:
            found[c] = join([get(w) if len(w) <= SHORT else self._long(w) for w in ws])
        self.memo.put_all(found)

    def _render_each(self, ids: np.ndarray, ends: list[int]) -> list:
        ids, render = ids.tolist(), self.render
        return [render(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def batch(self, texts: list[str]) -> Iterator[Iterator[list]]:
        """Each text's rendered tokens, piece by piece."""
        k = 0
        while k < len(texts):
            split, size, chunks = [], 0, set()
            for text in texts[k:]:
                if size + len(text) > BATCH and split:
                    break
                size += len(text)
                plain = len(text) <= PIECE and not ("<|" in text and self.table.special_re)
                split.append(self._split(text) if plain else None)
                chunks.update(split[-1] or ())
            self.learn(chunks)
            for text, own in zip(texts[k:], split):
                yield self.whole(text) if own is None else iter([list(map(self.memo.__getitem__, own))])
            k += len(split)

    def _split(self, text: str) -> list[str]:
        low = self.table.normalise(text)
        return regex.split(r"\p{White_Space}+", low) if _ODD.search(low) else low.split()

    def feed(self, text: str) -> list:
        """Takes more text; returns what has become stable."""
        out: list = []
        self.raw += text
        while len(self.raw) > PIECE:
            window = self.raw[:PIECE]
            cut = max((m.end() for m in _SPACE.finditer(window, max(0, PIECE - 4096))), default=0) \
                or max((m.end() for m in _SPACE.finditer(window)), default=0)
            inner = 0
            if not cut:
                inner = max((m.end() for m in _INNER.finditer(window)), default=0)
            if not cut and not inner:
                m = _SPACE.search(self.raw) or _INNER.search(self.raw)
                if not m:
                    break  # neither a blank nor two plain characters: wait for more
                cut, inner = (m.end(), 0) if m.re is _SPACE else (0, m.end())
            piece, self.raw = self.raw[:cut or inner], self.raw[cut or inner:]
            out += self._piece(piece, goes_on=bool(inner))
        return out

    def finish(self) -> list:
        """The rest of the document; the encoder is then ready for the next one."""
        rest, self.raw = self.raw, ""
        return self._piece(rest, goes_on=False)

    def whole(self, text: str) -> Iterator[list]:
        """All of a document, piece by piece."""
        if len(text) <= PIECE:
            yield self._piece(text, goes_on=False)
            return
        for k in range(0, len(text), PIECE):
            yield self.feed(text[k:k + PIECE])
        yield self.finish()

    def _piece(self, text: str, goes_on: bool) -> list:
        if self.open is None and not goes_on and not (text.count("<|") and self.table.special_re):
            return self._plain(text)
        out: list = []
        pos = 0
        for m in self.table.special_re.finditer(text) if self.table.special_re else ():
            out += self._segment(text[pos:m.start()], False)
            out.append(self.render([self.table.special[m.group()]]))
            pos = m.end()
        return out + self._segment(text[pos:], goes_on)

    def _plain(self, text: str) -> list:
        return list(map(self.memo.__getitem__, self._split(text)))

    def _segment(self, text: str, goes_on: bool) -> list:
        """A piece whose first word may continue an open one and whose last word may stay open."""
        low = self.table.normalise(text)
        out: list = []
        words = [m.span() for m in self.table.pattern.finditer(low)]
        if self.open is not None:
            if words and words[0][0] == 0 and low[0].isalpha():
                a, b = words.pop(0)
                out.append(self.render(list(self.open.feed(low[a:b].encode()))))
                if not words and goes_on and b == len(low) and low[-1].isalpha():
                    return out
            out.append(self.render(list(self.open.finish())))
            self.open = None
        last = None
        if goes_on and words and words[-1][1] == len(low) and low[words[-1][0]].isalpha():
            last = words.pop()
        for a, b in words:
            if b - a <= SHORT:
                out.append(self.words[low[a:b]])
            else:
                out.append(self._long(low[a:b]))
        if last:
            self.open = WordTransducer(self.table)
            out.append(self.render(list(self.open.feed(low[last[0]:last[1]].encode()))))
        return out


class StreamDecoder:
    """Ids to text, one id at a time.

    ``joined`` (the file names no decoder): each id's token, with one blank
    between two; the only state is whether a token has been written.  Otherwise
    byte level: tokens are bytes, and the state is the unfinished UTF-8
    sequence (at most three bytes).
    """

    def __init__(self, table: MergeTable, joined: bool | None = None):
        self.tokens, self.joined = table.tokens, table.joined if joined is None else joined
        self.bytes = {c: b for b, c in enumerate(table.alphabet)}
        self.utf8, self.started = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: list[int]) -> str:
        known = [t for t in map(self.tokens.get, ids) if t is not None]
        if self.joined:
            text = (" " if self.started and known else "") + " ".join(known)
            self.started |= bool(known)
            return text
        return self.utf8.decode(bytes(self.bytes[c] for t in known for c in t))

    def finish(self) -> str:
        return "" if self.joined else self.utf8.decode(b"", final=True)


_LOADED: dict = {}


def loaded(path: str, key: str, make):
    """One encoder per worker process, file and use; workers live on between tasks."""
    if (path, key) not in _LOADED:
        # the memos hold many small objects without cycles; scanning them often would cost a quarter of the time
        gc.set_threshold(200_000, 50, 100)
        _LOADED[path, key] = make(MergeTable(path))
    return _LOADED[path, key]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(entries: list[tuple]) -> tuple | None:
    if not entries:
        return None
    n, ids, text = zip(*entries)
    return sum(n), " ".join(ids), " ".join(text)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256 (decimal ids joined by one
    blank), decoded_sha256 (UTF-8 of the decoded text).  Narrow: no shuffle, constant memory per text."""
    prepare(docs.sparkSession)

    def encoder(table: MergeTable) -> StreamEncoder:
        return StreamEncoder(
            table, lambda ids: (len(ids), " ".join(map(str, ids)), StreamDecoder(table).feed(ids)) if ids else None,
            lambda es: es[0] if len(es) == 1 else _joined([e for e in es if e]))

    def run(batches):
        enc: StreamEncoder = loaded(path, "round_trip", encoder)
        if not enc.table.joined:
            raise ValueError("round_trip expects a file without a decoder")
        for b in batches:
            rows: list[tuple] = []
            for doc_id, parts in zip(b.column(0).to_pylist(), enc.batch(b.column(1).to_pylist())):
                n, ids, dec, sep = 0, hashlib.sha256(), hashlib.sha256(), ""
                for part in parts:
                    part = [e for e in part if e]
                    if part:
                        ns, i, d = zip(*part)
                        ids.update((sep + " ".join(i)).encode())
                        dec.update((sep + " ".join(d)).encode())
                        n, sep = n + sum(ns), " "
                rows.append((doc_id, n, ids.hexdigest(), dec.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) if rows else _EMPTY
    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


_EMPTY = pa.RecordBatch.from_arrays(
    [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string())],
    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>): the encoder's real output."""
    prepare(docs.sparkSession)

    def run(batches):
        enc: StreamEncoder = loaded(path, "ids", lambda t: StreamEncoder(t, list, lambda es: [i for e in es for i in e]))
        for b in batches:
            ids = [[i for part in parts for e in part for i in e] for parts in enc.batch(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, path: str) -> DataFrame:
    """doc_id, ids -> doc_id, text (null ids: empty text)."""
    prepare(df.sparkSession)

    def run(batches):
        table: MergeTable = loaded(path, "decode", lambda t: t)
        for b in batches:
            texts = []
            for ids in b.column(1).to_pylist():
                d = StreamDecoder(table)
                texts.append("".join([*(d.feed([i]) for i in ids or []), d.finish()]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
