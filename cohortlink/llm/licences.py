"""Operator 5: licence scan by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright lines dropped,
punctuation and blanks to single blanks, equivalent spellings to one.  Its
digest is looked up among the digests of known licences, an equi-join with a
table of fixed size.  Whole documents are looked up as licence texts, each of
their lines as a licence notice (a line's copyright words are kept, so that
"All rights reserved." is found).  Short texts are kept as text, the full texts
of the long licences as fixed digests.

Only texts that contain one of CUES are brought to canonical form.  Every
known text has one of them, and the canonical form never makes one up, so no
match is lost (tested).

DataFrame and SQL functions only; no shuffle.

Defined cases: null and empty texts match nothing; a line that occurs often
in a document is one notice and counts every time; equal rows get equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, prepare
from cohortlink.llm.licence_texts import DIGESTS, NAMES, OTHER_CLASSES, SENTENCES, TEXTS

CUES = "licen[cs]|permission|redistribution|reserved|released|distributed|available|unencumbered|warranty"
# Spellings that count as one.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"), ("favour", "favor"),
    ("acknowledgement", "acknowledgment"), ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("whilst", "while"), ("recognise", "recognize"), ("https", "http"), ("and or", "or"),
    ("merchantibility", "merchantability"),
]
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright[^a-z0-9\n]*(\(c\)|©|[0-9])|\(c\)|©|all rights reserved)[^\n]*"


def canonical(text: Column, whole: bool) -> Column:
    """Canonical form; ``whole``: of a licence text, without its copyright lines."""
    t = F.lower(text)
    if whole:
        t = F.regexp_replace(t, COPYRIGHT_LINE, "\n")
    t = F.trim(F.regexp_replace(t, "[^a-z0-9]+", " "))
    for a, b in SPELLINGS:
        t = F.regexp_replace(t, rf"\b{a}", b)
    return t


def known_rows() -> list[tuple[str, str, bool]]:
    """(licence, text, whole) of every known text and notice."""
    rows = [(k, t, True) for k, ts in TEXTS.items() for t in ts]
    rows += [(k, s.format(name=n, id=k), False) for k, (_, ns) in NAMES.items() for n in ns for s in SENTENCES]
    return rows + [("all-rights-reserved", "All rights reserved", False)]


def known(spark: SparkSession) -> DataFrame:
    """(digest, licence, whole): fixed size."""
    rows = spark.createDataFrame(known_rows(), "licence string, text string, whole boolean")
    both = F.when(F.col("whole"), canonical(F.col("text"), True)).otherwise(canonical(F.col("text"), False))
    full = spark.createDataFrame([(x, True, k) for k, xs in DIGESTS.items() for x in xs], "digest string, whole boolean, licence string")
    return rows.select(F.sha2(both, 256).alias("digest"), "whole", "licence").unionAll(full).groupBy("digest", "whole").agg(
        F.min("licence").alias("licence"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licence (of the whole text, or null), notices (distinct, sorted, comma-joined), n_notices,
    restricted (a notice or the text is of a restricted licence): one row per document."""
    prepare(docs.sparkSession)
    table = known(docs.sparkSession)
    cue = F.lower("text").rlike(CUES)
    d = narrow(docs, id_col, text_col).withColumn("cued", cue).select(
        "doc_id", F.xxhash64("text").alias("key"), F.when(F.col("cued"), F.sha2(canonical(F.col("text"), True), 256)).alias("digest"),
        F.when(F.col("cued"), F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.lower(x).rlike(CUES)),
                                          lambda x: F.sha2(canonical(x, False), 256))).alias("lines"))
    d = materialise(d, "licence_digests")
    closed = [k for k, c in {**{k: c for k, (c, _) in NAMES.items()}, **OTHER_CLASSES}.items() if c == "restricted"]
    # the table of known digests is a fixed value of the library
    lines = d.where(F.size("lines") > 0).dropDuplicates(["doc_id", "key"]).select(
        "doc_id", "key", F.explode("lines").alias("digest"))
    notices = lines.join(F.broadcast(table.where("not whole")), "digest").groupBy("doc_id", "key").agg(
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"), F.count("*").alias("n"),
        F.max(F.col("licence").isin(closed)).alias("closed")).withColumnsRenamed({"doc_id": "id", "key": "k"})
    return d.join(F.broadcast(table.where("whole").drop("whole")), "digest", "left").join(
        notices, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left").select(
        "doc_id", "licence", F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
        (F.coalesce("closed", F.lit(False)) | F.coalesce(F.col("licence").isin(closed), F.lit(False))).alias("restricted"))


def _sql_canonical(text: str, whole: bool) -> str:
    t = f"lower({text})"
    if whole:
        t = f"regexp_replace({t}, '{COPYRIGHT_LINE}', chr(10), 'g')"
    t = f"trim(regexp_replace({t}, '[^a-z0-9]+', ' ', 'g'))"
    for a, b in SPELLINGS:
        t = f"regexp_replace({t}, '\\b{a}', '{b}', 'g')"
    return t


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB: the same rules, without the cue filter and without DIGESTS."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(k)}, {quoted(t)}, {str(w).lower()})" for k, t, w in known_rows())
    closed = ", ".join(quoted(k) for k, c in {**{k: c for k, (c, _) in NAMES.items()}, **OTHER_CLASSES}.items() if c == "restricted")
    return f"""
WITH texts(licence, t, whole) AS (VALUES {rows}),
known AS (SELECT whole, CASE WHEN whole THEN {_sql_canonical("t", True)} ELSE {_sql_canonical("t", False)} END AS c,
                 min(licence) AS licence FROM texts GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lines AS (SELECT doc_id, {_sql_canonical("x", False)} AS c
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE lower(x) SIMILAR TO '.*({CUES}).*'),
notices AS (SELECT l.doc_id, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS notices, count(*) AS n,
                   bool_or(k.licence IN ({closed})) AS closed
            FROM lines l JOIN known k ON k.c = l.c AND NOT k.whole GROUP BY l.doc_id)
SELECT d.doc_id, k.licence, coalesce(n.notices, '') AS notices, coalesce(n.n, 0)::BIGINT AS n_notices,
       (coalesce(n.closed, false) OR coalesce(k.licence IN ({closed}), false)) AS restricted
FROM d LEFT JOIN known k ON k.whole AND k.c = {_sql_canonical("d.t", True)} LEFT JOIN notices n ON n.doc_id = d.doc_id
"""
