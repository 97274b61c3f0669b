"""Operator 9: MinHash near-duplicates by a signature-coordinate inverted join.

Every text becomes the set of its distinct shingles (``words`` words, two by
default) and a signature of ``COORDS`` minima.  Texts with equal sets are one *class*, kept under its
smallest id.  A class is posted under its (coordinate, value) pairs, rarest
first.  Two signatures that agree in at least ``MATCHES`` coordinates share a
pair among the first ``size - MATCHES + 1`` posted pairs of each (prefix
filter), and a class with fewer than ``MATCHES`` pairs that occur elsewhere
has no partner at all (skip).  Candidates whose signatures agree often enough
are confirmed on the full sets.

At a similarity of 0.8 the agreeing coordinates are binomial (64, 0.8); fewer
than 36 of them have a probability of about 4e-6 (and of 1e-8 at 0.85).

Groups of near copies are not expanded to all pairs: classes under a pair are
first compared with one hub per pair (several rounds, another hub each time),
then only classes that are still in different components are compared with
each other.  A pair within one component cannot change the result, so no link
between components is lost.  Before that last comparison the agreeing coordinates
are counted inside the join on the pair, from a few bits of every minimum that
are posted with it, and only classes with a partner that agrees often enough
stay.  It then keeps a pair only if it can reach the similarity: two sets share
at most the smaller count of their frequent shingles (those that more than
``RARE`` of the compared classes hold) plus the rare ones that both hold.  Pairs
without a common rare shingle are bounded inside the join on the posted pair and
leave it at the first such pair they share; pairs with one are found by a join
on the rare shingles and counted.  The bound is exact for every ``RARE``, which
only moves work between the two.

Defined cases: null or empty text has an empty set and links with nothing;
one word is one shingle; equal texts share a class; rows with a null id keep
their row, link with nothing and are kept; rows that share an id but not the
text belong to classes of their own (``text_hash`` tells them apart).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, perhaps, prepare
from cohortlink.llm.graph import components

COORDS = 64
MATCHES = 36
SHINGLE = 2
SIMILARITY = 80
#: rounds of comparing with hubs before the remaining pairs are compared
HUB_ROUNDS = 3
#: a shingle that at most so many compared classes hold is rare
RARE = 64
#: low bits of each minimum that the last comparison looks at
BITS = 4

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * _M1)
_A, _B = _SEEDS[:COORDS, None] | np.uint64(1), _SEEDS[COORDS:, None]


def shingle_set(data: bytes, words: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text (A-Z lower-cased)."""
    w = data.lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    if len(h) < words:
        return _mix(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=1)], np.uint64)) if w else h
    s = np.zeros(len(h) - words + 1, np.uint64)
    for k in range(words):
        s = _mix(s + _M1 + h[k:len(h) - words + 1 + k])
    return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    """Minimum of each of COORDS hash functions over the set."""
    low = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(s), 1024):
        np.minimum(low, (s[k:k + 1024] * _A + _B).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, d1, d2 (digest of the set), sig (COORDS ints)."""
    prepare(docs.sparkSession)
    names = ["doc_id", "text_hash", "n_shingles", "d1", "d2", "sig"]

    def run(batches):
        for b in batches:
            rows = []
            for i, t, h in zip(*(b.column(k).to_pylist() for k in range(3))):
                s = shingle_set(t.encode(), words)
                d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                rows.append((i, h, len(s), int(d[0]), int(d[1]), signature(s)))
            cols = list(zip(*rows)) if rows else [()] * 6
            flat = np.concatenate(cols[5]) if rows else np.zeros(0, np.int32)
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * COORDS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), sig], names)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, sig array<int>")


def postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(token, rep, n, weight): classes under their prefix of coordinate-value pairs, rarest first.

    ``weight``: how often the class's pairs occur in all.  The text that near copies were made from has
    the largest, as it lacks the copies' changes; it is the best hub.
    """
    tokens = classes.select("rep", "n", F.posexplode("sig").alias("c", "v")).select(
        "rep", "n", F.xxhash64("c", "v").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    own = tokens.join(often, "token").groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("f", "token"))).alias("own"))
    return own.where(F.size("own") >= matches).select(
        "rep", "n", F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x.f).alias("weight"),
        F.explode(F.expr(f"slice(own, 1, size(own) - {matches - 1})")).alias("t")).select(
        F.col("t.token").alias("token"), "rep", "n", "weight")


def blobs(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, blob and whatever else ``wanted`` has: the compressed text of the wanted classes (rep, doc, text_hash)."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([z.compress(t.encode()) for t in b.column(1).to_pylist()], pa.binary())],
                ["doc", "text_hash", "blob"])
    own = docs.where("doc_id is not null").select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("text_hash"))
    packed = perhaps(own, wanted, "doc", "text_hash").mapInArrow(run, "doc long, text_hash long, blob binary")
    # rows equal in id and text go before the join, which needs them dealt in the same way
    return packed.dropDuplicates(["doc", "text_hash"]).join(wanted, ["doc", "text_hash"]).drop("doc", "text_hash")


def low_bytes(sig: str):
    """The low bytes of a signature's minima as one binary value."""
    return F.unhex(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(255))), 2, "0")), ""))


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int, matches: int) -> DataFrame:
    """(a, b, linked): pairs that agree in enough coordinates, confirmed on the full sets."""
    def side(name: str, column: str) -> DataFrame:
        return texts.select(F.col("rep").alias(name), F.col(column).alias(f"{column}_{name}"))

    # the low byte of each minimum: agreeing minima have agreeing bytes, so no pair is lost
    agree = F.expr("aggregate(sequence(1, length(low_a)), 0, (n, i) -> n + int(substr(low_a, i, 1) = substr(low_b, i, 1)))")
    near = materialise(pairs.join(side("a", "low"), "a").join(side("b", "low"), "b").where(agree >= matches).select("a", "b"), "near_pairs")
    # each round compares a part of the texts, so only that part is shuffled
    rows = near
    for name in ("b", "a"):
        rows = rows.join(perhaps(side(name, "blob"), near.select(name), name), name)
    rows = rows.select("a", "b", "blob_a", "blob_b")

    def run(batches):
        z, last = zstandard.ZstdDecompressor(), (None, None)
        for b in batches:
            out = []
            for x, y, p, q in zip(*(b.column(k).to_pylist() for k in range(4))):
                if last[0] != x:
                    last = x, shingle_set(z.decompress(p), words)
                out.append(similar(last[1], shingle_set(z.decompress(q), words), percent))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.bool_())], ["a", "b", "linked"])
    return rows.mapInArrow(run, "a long, b long, linked boolean")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                    percent: int = SIMILARITY, matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash: one row per document."""
    prepare(docs.sparkSession)
    docs = narrow(docs, id_col, text_col)
    sigs = materialise(signatures(docs, words), "signatures")
    classes = materialise(_classes(sigs.where("n_shingles > 0 and doc_id is not null")), "classes")
    posts = materialise(postings(classes, matches), "postings")
    links = link_classes(posts, classes, docs, words, percent, matches)
    label = components(links).select(F.col("node").alias("rep"), "component").join(classes.select("rep", "doc"), "rep")
    least = label.groupBy("component").agg(F.min("doc").alias("least"))
    label = label.join(least, "component").select("rep", F.col("least").alias("component"))
    known = classes.join(label, "rep", "left").select(
        "d1", "d2", F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component"))
    return sigs.select("doc_id", "text_hash", "n_shingles", "d1", "d2").join(known, ["d1", "d2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", *_verdict(), "text_hash")


def _classes(sigs: DataFrame) -> DataFrame:
    """d1, d2, n, sig, doc and text_hash (of the first row), rep: a number of the class's own, its first
    id unless another class has the same one."""
    c = sigs.groupBy("d1", "d2", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("f"), F.first("sig").alias("sig")).select(
        "d1", "d2", F.col("n_shingles").alias("n"), "sig", F.col("f.doc_id").alias("doc"), F.col("f.text_hash").alias("text_hash"))
    shared = c.groupBy("doc").agg(F.count("*").alias("c")).where("c > 1").select("doc", F.lit(True).alias("shared"))
    own = -F.xxhash64("doc", "d1", "d2").bitwiseAND((1 << 63) - 1) - 1
    return materialise(c, "classes").join(shared, "doc", "left").select(
        "d1", "d2", "n", "sig", "doc", "text_hash", F.when(F.col("shared"), own).otherwise(F.col("doc")).alias("rep"))


def _verdict():
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept")


def link_classes(posts: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int,
                 matches: int) -> DataFrame:
    """(a, b): confirmed links that connect every component of similar classes."""
    spark = posts.sparkSession
    wanted = materialise(classes.select("rep", "doc", "text_hash", low_bytes("sig").alias("low")).join(
        posts.select("rep").distinct(), "rep", "left_semi"), "wanted")
    texts = materialise(blobs(docs, wanted), "texts")
    empty = spark.createDataFrame([], "a long, b long, linked boolean")
    tested, label, active = empty, None, posts.withColumn("component", F.col("rep"))
    for k in range(HUB_ROUNDS + 1):
        if k:
            label = components(tested.where("linked")).select(F.col("node").alias("rep"), "component")
            active = posts.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            mixed = active.groupBy("token").agg(F.count("*").alias("c"), F.min("component").alias("lo"),
                                                F.max("component").alias("hi")).where("c > 2 and lo < hi")
            active = materialise(active.join(mixed.select("token"), "token"), "active")
            if active.isEmpty():
                break
        pairs = hub_pairs(active, k) if k < HUB_ROUNDS else cross_pairs(materialise(possible_rows(
            active, with_bits(classes), percent, matches), "possible"), texts, words, percent)
        near = F.col("m") * 100 >= F.col("n") * percent, F.col("n") * 100 >= F.col("m") * percent
        pairs = pairs.where(near[0] & near[1]).select(
            F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
        if k:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        new = confirm(pairs, texts, words, percent, matches)
        tested = materialise(new if not k else tested.unionAll(new), "tested")
    return tested.where("linked").select("a", "b")


def hub_pairs(active: DataFrame, turn: int) -> DataFrame:
    """Each class under a token with the token's hub of this round, unless already connected."""
    first = -F.col("weight") if not turn else F.lit(0).cast("long") if turn == 1 else F.xxhash64(F.lit(turn), "rep")
    order = F.struct(first.alias("order"), "rep", "n", "component")
    hubs = active.groupBy("token").agg(F.min(order).alias("h"), F.count("*").alias("c")).where("c > 1").select(
        "token", F.col("h.rep").alias("hub"), F.col("h.n").alias("m"), F.col("h.component").alias("hub_component"))
    return active.join(hubs, "token").where("component <> hub_component").select("hub", "m", "rep", "n")


def with_bits(classes: DataFrame) -> DataFrame:
    """rep, b0 to b3: bit k of every minimum of the signature, one long of COORDS bits each."""
    return classes.select("rep", *[F.expr(
        f"aggregate(transform(sig, (v, i) -> shiftleft(cast((v >> {k}) & 1 as long), i)), 0L, (a, x) -> a | x)").alias(f"b{k}")
        for k in range(BITS)])


def possible_rows(active: DataFrame, bits: DataFrame, percent: int, matches: int) -> DataFrame:
    """The rows (token, rep, n, component) of ``active`` that have a partner under their token: a class of another
    component whose size allows the similarity and whose signature can agree often enough.

    The signatures' low bits travel with the posting, and the agreeing coordinates are counted inside the join on
    the token: minima that agree have agreeing bits, so no pair is lost, and a pair of unrelated minima passes in
    one of 2 ** BITS cases.  The joins are semi joins: a row leaves once or not at all.  The conditions are the same
    under every token, so a pair keeps all the tokens it shares.
    """
    active = active.select("token", "rep", "n", "component").join(bits, "rep")
    sizes = active.groupBy("token", "component").agg(F.count("*").alias("c"))
    most = sizes.groupBy("token").agg(F.max(F.struct("c", "component")).alias("x")).select(
        "token", F.col("x.component").alias("largest"))
    few = active.join(most, "token").where("component <> largest").drop("largest")

    def partnered(some: DataFrame, others: DataFrame) -> DataFrame:
        o = others.select(F.col("token").alias("t"), F.col("n").alias("m"), F.col("component").alias("other"),
                          *[F.col(f"b{k}").alias(f"h{k}") for k in range(BITS)])
        unlike = " | ".join(f"(b{k} ^ h{k})" for k in range(BITS))
        near = ((F.col("token") == F.col("t")) & (F.col("component") != F.col("other"))
                & (F.col("m") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("m") * percent)
                & F.expr(f"{COORDS} - bit_count({unlike}) >= {matches}"))
        return some.join(o, near, "left_semi").select("token", "rep", "n", "component")
    return partnered(active, few).unionAll(partnered(few, active)).distinct()


def shingle_rows(texts: DataFrame, words: int) -> DataFrame:
    """(rep, s): the distinct shingles of each text."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for rep, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = shingle_set(z.decompress(blob), words)
                for k in range(0, len(s), 65536):
                    part = s[k:k + 65536].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), rep)), pa.array(part)], ["rep", "s"])
    return texts.select("rep", "blob").mapInArrow(run, "rep long, s long")


def cross_pairs(active: DataFrame, texts: DataFrame, words: int, percent: int, rare: int | None = None) -> DataFrame:
    """Classes under a token that are still in different components and can be similar: every class outside
    the token's largest component with every class of another component."""
    rare = RARE if rare is None else rare
    reps = active.select("rep", "n", "component").distinct()
    held = materialise(shingle_rows(perhaps(texts, reps, "rep").join(reps.select("rep"), "rep", "left_semi"), words), "shingles")
    often = held.groupBy("s").agg(F.count("*").alias("c")).where(F.col("c") > rare).select("s")
    low = materialise(held.join(often, "s", "left_anti"), "rare_shingles")
    reps = materialise(reps.join(low.groupBy("rep").agg(F.count("*").alias("low")), "rep", "left").select(
        "rep", "n", "component", (F.col("n") - F.coalesce("low", F.lit(0))).alias("frequent")), "shared_counts")

    def possible(both):
        return 100 * both >= percent * (F.col("n") + F.col("m") - both)

    most_shared = F.least("frequent", "hub_frequent")
    hub = [F.col("rep").alias("hub"), F.col("n").alias("m"), F.col("component").alias("hub_component"),
           F.col("frequent").alias("hub_frequent")]
    # a class's posted tokens (at most COORDS): two classes are paired under the smallest they share
    own = active.groupBy("rep").agg(F.sort_array(F.collect_list("token")).alias("own"))
    active = active.select("token", "rep").join(reps.join(own, "rep"), "rep")
    sizes = active.groupBy("token", "component").agg(F.count("*").alias("c"))
    most = sizes.groupBy("token").agg(F.max(F.struct("c", "component")).alias("x")).select(
        "token", F.col("x.component").alias("largest"))
    few = active.join(most, "token").where("component <> largest").select("token", *hub, F.col("own").alias("hub_own"))
    first = F.get(F.array_intersect("own", "hub_own"), F.lit(0))
    apart = active.join(few, "token").where((F.col("component") != F.col("hub_component")) & possible(most_shared)
                                            & (first == F.col("token")))
    low = low.join(reps, "rep")
    sharing = low.join(low.select("s", *hub), "s").where("rep < hub and component <> hub_component").groupBy(
        "hub", "m", "rep", "n", most_shared.alias("shared")).agg(F.count("*").alias("k"))
    names = ["hub", "m", "rep", "n"]
    return apart.select(*names).unionAll(sharing.where(possible(F.col("shared") + F.col("k"))).select(*names))
