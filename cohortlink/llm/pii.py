"""Operator 3: personal data by base patterns and bootstrapped context patterns.

Base spans (email, ip, card, phone) come from patterns and checks.  The method
adds identifiers no pattern describes: every word with a digit or @ is a possible
*instance*, the words around it are its *patterns* (the two words before; the
word before and the word after).  Instances that overlap a base span are seeds.
A pattern's confidence is the summed score of the instances it surrounds over
all places of the corpus where its words occur, an instance's score the best
confidence of its patterns; both are recomputed on the pattern-instance graph
until they rest (they only rise, so they do).  A pattern that touches no seed
enters through instances that an earlier round found.  Patterns of high
confidence and support then mark the identifiers they surround (kind ``context``).

Frequent words make chance patterns: many instances somewhere in a large
corpus, and far more places.  A pattern's confidence is at most its instances'
occurrences over its places, and its places in any part of the corpus are a
lower bound of all.  Patterns that this bound keeps below ``PASS_ON`` can neither
pass on nor mark, so they leave the graph before places are counted in the whole
corpus; the result is the same.

DataFrame and SQL functions only.  Patterns are written so that no text makes
the regular expressions backtrack (possessive, anchored at run starts).

Defined cases: null text is empty (no spans); positions count code points;
equal rows get equal spans; a null id keeps its row and its base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, prepare

KINDS = ["email", "ip", "card", "phone", "context"]
LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns (each equals the plain pattern of the contract, without backtracking)
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"(?<!\S)\S*[0-9@]\S*"
#: a word that is no seed counts as an identifier with so many characters and digits
LEAST_CHARS, LEAST_DIGITS = 6, 3
#: the scoring ends when a round raises the confidences by less than this in all
REST = 1e-6
#: one text in so many (by its hash) is the part of the corpus that bounds the places from below
PART = 16
#: distinct instances a pattern must surround, and the confidence with which it marks or passes on
SUPPORT, CONFIDENT, PASS_ON = 5, 0.8, 0.5

_DIGITS = "regexp_replace(m.text, '[^0-9]', '')"
_CHECKS = {
    "email": "true",
    "ip": r"forall(split(m.text, '\\.'), p -> length(regexp_replace(p, '^0+', '')) <= 3 and "
          r"int(concat('0', right(regexp_replace(p, '^0+', ''), 3))) <= 255)",
    "card": f"length({_DIGITS}) between 14 and 19 and aggregate(sequence(1, 19), 0, (a, i) -> a + "
            f"if(i > length({_DIGITS}), 0, "
            f"if(i % 2 = 1, int(substr({_DIGITS}, -i, 1)), int(substr('0246813579', int(substr({_DIGITS}, -i, 1)) + 1, 1)))"
            ")) % 10 = 0",
    "phone": f"length({_DIGITS}) between 10 and 15",
}
_CUES = {"email": "instr(text, '@') > 0", "ip": "text rlike '[0-9][.][0-9]'", "card": "text rlike '[0-9]'",
         "phone": "instr(text, '+') > 0"}


_NONE = "cast(array() as array<struct<start:int,end:int,text:string,left:string,right:string>>)"


def with_matches(d: DataFrame, name: str, cue: str, pattern: str) -> DataFrame:
    """Adds the matches of a pattern in ``text``, leftmost and not overlapping: array of
    (start, end, text, left, right), left and right being the text up to the neighbouring matches.

    The columns in between are steps of their own, so each is computed once per row.
    """
    d = d.withColumn("_m", F.when(F.expr(cue), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    d = d.withColumn("_m", F.when(F.size("_m") > 0, F.col("_m")))
    d = d.withColumn("_g", F.when(F.col("_m").isNotNull(), F.split("text", pattern, -1)))
    d = d.withColumn("_s", F.expr("""
        aggregate(zip_with(_m, slice(_g, 1, size(_m)), (m, g) -> struct(length(g) as gap, length(m) as len)),
                  struct(0 as at, cast(array() as array<int>) as s),
                  (a, x) -> struct(a.at + x.gap + x.len as at, concat(a.s, array(a.at + x.gap)) as s), a -> a.s)"""))
    d = d.withColumn(name, F.expr(f"""coalesce(transform(
        arrays_zip(_m, _s, slice(_g, 1, size(_m)), slice(_g, 2, size(_m))),
        x -> struct(x._s as start, x._s + length(x._m) as end, x._m as text, x.`2` as left, x.`3` as right)), {_NONE})"""))
    return d.drop("_m", "_g", "_s")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text) and per base kind an array of (start, end); ``words``: every word with a digit or @."""
    d = docs.withColumn("key", F.xxhash64("text"))
    for kind, pattern in PATTERNS.items():
        d = with_matches(d, kind, _CUES[kind], pattern)
        d = d.withColumn(kind, F.expr(
            f"transform(filter({kind}, m -> {_CHECKS[kind]}), m -> struct(m.start as start, m.end as end))"))
    return with_matches(d, "words", "text rlike '[0-9@]'", WORD).drop("text")


def instances(base: DataFrame) -> DataFrame:
    """One row per word with a digit or @: doc_id, key, start, end, instance, seed, patterns (hashes of its contexts)."""
    w = base.where(F.size("words") > 0).select(
        "doc_id", "key", F.concat("email", "ip", "card", "phone").alias("own"), F.explode("words").alias("w"))
    lead = F.length(F.regexp_extract("w.text", r"^[^A-Za-z0-9+]*", 0))
    core = F.regexp_extract("w.text", r"^[^A-Za-z0-9+]*+(.*?)[^A-Za-z0-9]*$", 1)
    before, after = F.split(F.trim(F.lower("w.left")), r"\s+"), F.split(F.trim(F.lower("w.right")), r"\s+")
    last, last2 = F.element_at(before, -1), F.try_element_at(before, F.lit(-2))
    return w.select(
        "doc_id", "key", (F.col("w.start") + lead).alias("start"), (F.col("w.start") + lead + F.length(core)).alias("end"),
        F.lower(core).alias("instance"),
        F.exists("own", lambda s: (s.start < F.col("w.end")) & (s.end > F.col("w.start"))).alias("seed"),
        F.array_compact(F.array(
            F.when(last2.isNotNull() & (last2 != ""), context_hash("before", last2, last)),
            F.when((last != "") & (after[0] != ""), context_hash("around", last, after[0])))).alias("patterns"))


def context_hash(kind: str, a: Column, b: Column) -> Column:
    return F.xxhash64(F.lit(kind), a, b)


def places(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, places): how often the words of each pattern occur in the whole corpus."""
    w = docs.select(F.split(F.trim(F.lower("text")), r"\s+").alias("w"))
    n = F.size("w")
    both = F.concat(
        F.transform(F.slice("w", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: context_hash(
            "before", x, F.element_at("w", i + 2))),
        F.transform(F.slice("w", F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: context_hash(
            "around", x, F.element_at("w", i + 3))))
    return w.select(F.explode(both).alias("pattern")).join(patterns, "pattern", "left_semi").groupBy("pattern").agg(
        F.count("*").alias("places"))


def possible_patterns(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(pattern): those with enough instances whose confidence the bound does not keep below PASS_ON."""
    often = materialise(edges.groupBy("pattern").agg(F.count("*").alias("kinds"), F.sum("n").alias("most")).where(
        f"kinds >= {SUPPORT}").select("pattern", "most"), "patterns")
    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(PART)) == 0)
    low = places(part, often.select("pattern"))
    return often.join(low, "pattern", "left").where(
        F.coalesce("places", F.lit(0)) * PASS_ON <= F.col("most")).select("pattern")


def confident_patterns(docs: DataFrame, occ: DataFrame) -> DataFrame:
    """(pattern): those whose confidence and support are high once the scores rest."""
    edges = materialise(occ.select("instance", "seed", F.explode("patterns").alias("pattern")).groupBy(
        "pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "all_edges")
    often = materialise(possible_patterns(docs, edges), "possible_patterns")
    edges = materialise(edges.join(often, "pattern", "left_semi"), "edges")
    total = materialise(places(docs, often), "places")
    score = edges.select("instance", "seed").where("seed").distinct().select("instance", F.lit(1.0).alias("score"))
    mark = None
    while True:
        conf = edges.join(score, "instance").groupBy("pattern").agg(
            F.sum(F.col("n") * F.col("score")).alias("mass"), F.count("*").alias("support")).join(
            total, "pattern").select("pattern", (F.col("mass") / F.col("places")).alias("confidence"), "support")
        conf = materialise(conf, "confidence")
        now = conf.agg(F.coalesce(F.sum("confidence"), F.lit(0.0)), F.coalesce(F.sum("support"), F.lit(0))).first()
        if mark is not None and now[1] == mark[1] and now[0] - mark[0] < REST:
            return conf.where(f"confidence >= {CONFIDENT} and support >= {SUPPORT}").select("pattern")
        mark = now
        score = edges.join(conf.where(f"confidence >= {PASS_ON} and support >= {SUPPORT}"), "pattern", "left").groupBy(
            "instance").agg(F.greatest(F.max(F.col("seed").cast("double")), F.least(
                F.coalesce(F.max("confidence"), F.lit(0.0)), F.lit(1.0))).alias("score")).where("score > 0")


def context_spans(docs: DataFrame, base: DataFrame) -> DataFrame:
    """doc_id, key, context: the identifiers that confident patterns surround."""
    occ = instances(base).where(
        F.col("seed") | (F.length("instance") >= LEAST_CHARS) &
        (F.length(F.regexp_replace("instance", "[^0-9]", "")) >= LEAST_DIGITS))
    sure = confident_patterns(docs, occ)
    return occ.where("not seed").withColumn("pattern", F.explode("patterns")).join(sure, "pattern", "left_semi").groupBy(
        "doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("context"))


def spans(docs: DataFrame) -> DataFrame:
    """``base_spans`` without words, plus ``context`` (an array of (start, end), often empty)."""
    base = materialise(base_spans(docs), "base_spans")
    extra = materialise(context_spans(docs, base).withColumnRenamed("doc_id", "id"), "context_spans")
    base = base.drop("words").alias("b")
    return base.join(extra.alias("x"), F.col("b.doc_id").eqNullSafe(F.col("x.id")) & (F.col("b.key") == F.col("x.key")),
                     "left").select("b.*", F.coalesce("context", F.expr(
                         "cast(array() as array<struct<start:int,end:int>>)")).alias("context"))


def _ordered(kinds: list[str]) -> Column:
    """All spans of a row as (start, place of the kind, end, kind), by start, then kind."""
    return F.sort_array(F.concat(*(F.expr(
        f"transform({kind}, s -> struct(s.start as start, {place} as place, s.end as end, '{kind}' as kind))")
        for place, kind in enumerate(kinds))))


def _listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans."""
    return F.concat_ws(",", F.transform(_ordered(kinds), lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context: one row per document."""
    prepare(docs.sparkSession)
    d = spans(narrow(docs, id_col, text_col))
    return d.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
                    F.sha2(_listed(KINDS[:4]), 256).alias("base_sha256"), _listed(KINDS).alias("spans"),
                    F.size("context").cast("long").alias("n_context"))


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by [KIND]; overlapping spans become the first one's kind."""
    prepare(docs.sparkSession)
    d = spans(narrow(docs, id_col, text_col)).where(" or ".join(f"size({k}) > 0" for k in KINDS))
    hits = d.select("doc_id", "key", _ordered(KINDS).alias("spans")).distinct()
    # the document's own columns stay inside a struct, so none can clash with a work column
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.col(id_col).cast("long").alias("own_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = rows.join(hits, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("text") == F.col("key")), "left")
    text = F.col("text")
    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
                       lambda a, s: F.when(s.end <= a.at, a).otherwise(F.struct(
                           s.end.alias("at"), F.when(s.start < a.at, a.parts).otherwise(F.concat(a.parts, F.array(
                               F.substr(text, a.at + 1, s.start - a.at), F.concat(F.lit("["), F.upper(s.kind), F.lit("]"))))
                           ).alias("parts"))),
                       lambda a: F.concat(F.array_join(a.parts, ""), F.substr(text, a.at + 1, F.length(text))))
    own = F.col("doc").getField
    return out.select(*[F.when(F.col("spans").isNotNull(), done).otherwise(own(c)).alias(c) if c == text_col
                        else own(c).alias(c) for c in docs.columns])
