"""Operator 6: near-duplicate lines by a deletion-neighbourhood join.

Lines of all documents are compared after trimming blanks.  A line goes if an
equal line, or one within edit distance 1, occurs earlier (smaller doc_id, or
same document and earlier line).  Equal lines are pre-aggregated to their
earliest place.  For the rest every line emits its *variants* as hashed keys:
itself and, for each place, itself without the character there.  Equal keys
meet in one aggregate: a line and a line with one more character share a whole
line and a deletion; two lines that differ in one character share a deletion
at the same place.  The minimum place per key gives each line its earliest
neighbour, which is then verified with the edit distance.  No pair within a
key is formed.

Only lines that can have a neighbour emit variants, and only of the part that
can differ (exact, not a heuristic): lines one edit apart share their first or
their last half, so a line that shares neither is left out; and of ``BLOCKS``
blocks of the longer line they share all but one, so a line emits the variants
of those blocks whose surroundings another line has too.

Texts of lines are read again where few of them are wanted; ``common.perhaps``
leaves most others out before the exact join.

DataFrame and SQL functions only.

Defined cases: a null text has no lines; blank lines always stay; lines
shorter than ``LEAST`` characters are compared for equality only; rows that
share an id but not the text are documents of their own, ordered by a hash of
the text; rows equal in both count as one document and get the same result;
rows with a null id keep their lines and are no earlier occurrence for others;
columns of any name are carried without clashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise, narrow, perhaps, prepare

#: characters from which lines are compared with an edit bound
LEAST = 16
#: blocks of a line, one of which may hold the edit
BLOCKS = 8
BLANKS = " \t\x0b\f\r"


def place() -> Column:
    return F.struct("doc_id", "row", "at")


def digest(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def trimmed(line: Column) -> Column:
    """Without blanks at the ends; most lines have none, and trimming by a set of characters is slow."""
    blank = (F.instr(F.lit(BLANKS), F.left(line, F.lit(1))) > 0) | (F.instr(F.lit(BLANKS), F.right(line, F.lit(1))) > 0)
    return F.when(blank, F.btrim(line, F.lit(BLANKS))).otherwise(line)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), at, line: every line with a character that is not blank, trimmed."""
    return docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).select(
        "doc_id", "row", "at", trimmed(F.col("line")).alias("line")).where("line <> ''")


def half_keys(line: str, n: str) -> Column:
    """Keys of which two lines one edit apart share one or more: the first and the last characters, as many as
    half of the line and half of a line with one character less round down to (some null).

    The longer of two such lines shares its first or last (n - 1) / 2 characters with the other, and so any fewer.
    """
    def part(m: str) -> str:
        h = f"cast(({m} - 1) / 2 as int)"
        return f"if({h} < 32, {h}, {h} - {h} % 8)"
    own, less = part(n), part(f"({n} - 1)")
    keys = [f"xxhash64({k}, '{side}', {side}({line}, {k}))" for k in (own, less) for side in ("left", "right")]
    return F.expr(f"array({keys[0]}, {keys[1]}, if({own} <> {less}, {keys[2]}, null), if({own} <> {less}, {keys[3]}, null))")


def block_keys(few: DataFrame) -> DataFrame:
    """key, block, extra, before, after: for both lengths m (n + extra) of the longer line and each of its blocks
    the hash of what stands around the block, of which ``before`` and ``after`` are the characters."""
    at = few.select("key", "line", F.length("line").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(2 * BLOCKS - 1))).alias("x"))
    at = at.selectExpr("key", "line", f"cast(x / {BLOCKS} as int) as extra", f"x % {BLOCKS} as k", f"n + cast(x / {BLOCKS} as int) as m")
    at = at.selectExpr("key", "line", "extra", "k", "m", f"cast(k * m / {BLOCKS} as int) as before",
                       f"m - cast((k + 1) * m / {BLOCKS} as int) as after")
    return at.selectExpr("key", "xxhash64(m, k, left(line, before), right(line, after)) as block", "extra", "before", "after")


def variants(few: DataFrame) -> DataFrame:
    """first, variant, gone: of every block that may hold the edit the line itself, as the shorter of two (gone 0),
    or each deletion of one character of the block, as the longer (its place)."""
    b = materialise(block_keys(few), "block_keys")
    # a block's surroundings belong to a line of the longer length and to another line
    met = b.groupBy("block").agg(F.count("*").alias("c"), F.min("extra").alias("e")).where("c > 1 and e = 0").select("block")
    some = b.join(met, "block", "left_semi").join(few, "key").selectExpr(
        "first", "block", "extra", "substr(line, before + 1, length(line) - before - after) as part")
    return some.select("first", F.posexplode(F.expr("""transform(sequence(0, if(extra = 1, 0, length(part))), i ->
        if(i = 0, if(extra = 1, xxhash64(block, part), null), xxhash64(block, concat(left(part, i - 1), substr(part, i + 1)))))"""
        )).alias("gone", "variant")).where("variant is not null")


def earliest_neighbours(few: DataFrame) -> DataFrame:
    """first, other: the earliest place of a line that shares a variant in a way that means one edit."""
    v = materialise(variants(few), "variants")
    whole = v.where("gone = 0").select("variant", F.col("first").alias("as_whole"))
    # a whole line and the lines that become it by one deletion: each is the other's neighbour
    met = v.where("gone > 0").join(whole, "variant").select(F.col("first").alias("as_deletion"), "as_whole")
    same = v.where("gone > 0").groupBy("variant", "gone").agg(
        F.min("first").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
    equal = v.where("gone > 0").join(same, ["variant", "gone"]).select("first", F.col("least").alias("other"))
    return (met.select(F.col("as_deletion").alias("first"), F.col("as_whole").alias("other"))
            .unionAll(met.select(F.col("as_whole").alias("first"), F.col("as_deletion").alias("other")))
            .unionAll(equal)).groupBy("first").agg(F.min("other").alias("other"))


def spread(few: DataFrame) -> DataFrame:
    """The lines over all shuffle partitions: each becomes as many rows as it has variants."""
    return few.repartition(int(few.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")


def near_lines(every: DataFrame, distinct: DataFrame) -> DataFrame:
    """key of every distinct line that has an earlier line within edit distance 1, verified."""
    h = distinct.where("halves is not null").select(
        F.xxhash64("key").alias("short"), F.explode("halves").alias("half")).where("half is not null")
    shared = h.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    short = h.join(shared, "half", "left_semi").select("short").distinct()
    few = materialise(distinct.select("key", "first").withColumn("short", F.xxhash64("key")).join(
        short, "short", "left_semi").drop("short"), "keys_with_neighbours")
    few = materialise(perhaps(every, few, "key").join(few, "key").where(place() == F.col("first")).select(
        "key", "first", "line").dropDuplicates(["key"]), "lines_with_neighbours")
    found = earliest_neighbours(spread(few)).join(few, "first").where(F.col("other") < F.col("first"))
    text = few.select(F.col("first").alias("other"), F.col("line").alias("other_line"))
    return found.join(text, "other").where(F.levenshtein("line", "other_line", 1) >= 0).select("key").distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, row, at, near: the lines that go (near: no equal line occurs earlier)."""
    every = lines(docs).withColumn("key", digest(F.col("line")))
    places = materialise(every.withColumn("n", F.length("line")).select(
        "key", "doc_id", "row", "at", F.when(F.col("n") >= LEAST, half_keys("line", "n")).alias("halves")), "places")
    distinct = materialise(
        places.groupBy("key").agg(F.min(place()).alias("first"), F.first("halves").alias("halves"), F.count("*").alias("c")),
        "distinct_lines")
    near = materialise(near_lines(every, distinct), "near_lines")
    known = materialise(distinct.where("c > 1").select("key", "first").join(near.withColumn("near", F.lit(True)), "key", "full").select(
        "key", "first", "near"), "known_lines")
    return perhaps(places.drop("halves"), known, "key").join(known, "key").where((place() > F.col("first")) | F.col("near")).select(
        "doc_id", "row", "at", (~F.coalesce(place() > F.col("first"), F.lit(False))).alias("near"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc (a struct of its columns), text (its kept lines; the column
    itself where no line goes), n_lines, n_equal, n_near (lines that are not blank, removed as equal,
    removed as near)."""
    prepare(docs.sparkSession)
    own = removed_lines(narrow(docs, id_col, text_col)).groupBy("doc_id", "row").agg(
        F.collect_set("at").alias("gone"), F.countDistinct(F.when(~F.col("near"), F.col("at"))).alias("equal"),
        F.countDistinct(F.when(F.col("near"), F.col("at"))).alias("near"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # the document's own columns stay inside a struct, so none can clash with a work column
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"))
    # the text is taken from the struct after the join, so it is shuffled once
    text = F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit(""))
    out = whole.join(own, ["doc_id", "row"], "left").withColumn("parts", F.split(text, "\n", -1))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(parts) - 1), gone), i -> parts[i]), '\\n')")
    return out.select("doc", F.when(F.col("gone").isNotNull(), kept).otherwise(F.col("doc")[text_col]).alias("text"),
                      F.size(F.filter("parts", lambda x: trimmed(x) != "")).cast("long").alias("n_lines"),
                      F.coalesce("equal", F.lit(0)).alias("n_equal"), F.coalesce("near", F.lit(0)).alias("n_near"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_equal, n_near, text: one row per document."""
    return without_repeats(narrow(docs, id_col, text_col)).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_equal", "n_near", "text")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their kept lines; a document none of whose lines is left goes, unless it had none."""
    out = without_repeats(docs, id_col, text_col).where("n_lines = 0 or n_lines > n_equal + n_near")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])


#: the same rows in DuckDB: neighbours by plain pieces of the lines, without variants
ORACLE_SQL = f"""
WITH every AS (
  SELECT doc_id, unnest(range(len(l))) AS ln, unnest(l) AS raw
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
line AS (
  SELECT doc_id, ln, raw, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x FROM every),
uniq AS (
  SELECT x, min(struct_pack(doc_id := doc_id, ln := ln)) AS first, length(x) AS n FROM line WHERE x <> '' GROUP BY x),
long AS (SELECT *, (n - 1) // 2 AS h, n // 2 AS g FROM uniq WHERE n >= {LEAST}),
half AS (
  SELECT x, first, n, n AS m, 'l' AS side, left(x, h) AS part FROM long
  UNION ALL SELECT x, first, n, n, 'r', right(x, h) FROM long
  UNION ALL SELECT x, first, n, n + 1, 'l', left(x, g) FROM long
  UNION ALL SELECT x, first, n, n + 1, 'r', right(x, g) FROM long),
pair AS (
  SELECT DISTINCT a.x AS x, a.n AS n, b.x AS y, b.n AS m
  FROM half a JOIN half b ON a.m = b.m AND a.side = b.side AND a.part = b.part AND b.first < a.first),
lcp AS (
  SELECT x, y, n, m, (SELECT count(*) FROM range(1, least(n, m) + 1) r(k) WHERE left(x, k::BIGINT) = left(y, k::BIGINT)) AS p
  FROM pair),
near AS (
  SELECT DISTINCT x FROM lcp
  WHERE CASE WHEN n = m THEN substr(x, p + 2) = substr(y, p + 2)
             WHEN n > m THEN substr(x, p + 2) = substr(y, p + 1)
             ELSE substr(x, p + 1) = substr(y, p + 2) END),
judged AS (
  SELECT l.*, l.x <> '' AS has, coalesce(u.first < struct_pack(doc_id := l.doc_id, ln := l.ln), false) AS equal,
         r.x IS NOT NULL AS near
  FROM line l LEFT JOIN uniq u ON u.x = l.x LEFT JOIN near r ON r.x = l.x)
SELECT doc_id, count(*) FILTER (WHERE has) AS n_lines, count(*) FILTER (WHERE equal) AS n_equal,
       count(*) FILTER (WHERE near AND NOT equal) AS n_near,
       coalesce(string_agg(raw, chr(10) ORDER BY ln) FILTER (WHERE NOT equal AND NOT near), '') AS text
FROM judged GROUP BY doc_id
"""
