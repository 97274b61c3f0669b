"""Column -> Column rules.

All are built-in expressions: they stay inside whole-stage codegen and run
where the rows are; nothing here shuffles.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_split(col: Column, sep: str) -> Column:
    """split on a literal separator (split() takes a regex)."""
    return F.split(col, "\\Q" + sep + "\\E")


# ----------------------------------------------------------------- O10 keys
def field(col, sep: str, n: int) -> Column:
    """n-th (1-based) field of a ``sep``-separated text, like ``cut -d sep -fn``.

    A text without the separator is returned whole (as ``cut`` does).
    """
    c = _c(col)
    return F.when(F.instr(c, sep) == 0, c).otherwise(F.get(_lit_split(c, sep), n - 1))


def subject_id(col, sep: str = "_") -> Column:
    """Subject id without prefix: ``NDAR_INVX`` -> ``INVX`` (second field)."""
    return field(col, sep, 2)


def with_prefix(subject, prefix: str = dims.SUBJECT_PREFIX, sep: str = "_") -> Column:
    """``INVX`` -> ``NDAR_INVX``."""
    return F.concat(F.lit(prefix + sep), _c(subject))


def without_sep(col, sep: str = "_") -> Column:
    """Remove every separator: ``NDAR_INVX`` -> ``NDARINVX`` (raw-file and BIDS key)."""
    return F.replace(_c(col), F.lit(sep), F.lit(""))


# -------------------------------------------------------------- O11 alias
def site_alias(col, mapping: dict[str, str] | None = None) -> Column:
    """Output-folder alias of a site; unknown sites keep their name."""
    mapping = dims.SITE_ALIAS if mapping is None else mapping
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    m = F.create_map(*items)
    return F.coalesce(F.try_element_at(m, _c(col)), _c(col))


# ---------------------------------------------------------- O19 private TI
def private_value(col, json_path: str | None = None) -> Column:
    """A private numeric field, null when absent or NaN.

    ``col`` is either a decoded double or, with ``json_path``, a JSON text.
    """
    c = _c(col)
    if json_path is not None:
        c = F.get_json_object(c, json_path)
    v = c.try_cast("double")
    return nan_to_null(v)


def nan_to_null(col) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# ------------------------------------------------------ O31 maker limit
def max_images(manuf) -> Column:
    """Images allowed per maker: GE 1, PH(ilips) 2, SI(emens) 1, else null."""
    u = F.upper(_c(manuf))
    return (F.when(u.contains("GE"), F.lit(1))
             .when(u.contains("PH"), F.lit(2))
             .when(u.contains("SI"), F.lit(1)))


# ------------------------------------------------------ O37 visit name
def capitalize(col) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title(col) -> Column:
    """Python ``str.title``: a letter after a non-letter is upper, others lower.

    ``initcap`` only starts words after blanks, so a blank is put before every
    letter that follows a non-letter, ``initcap`` runs, and exactly those
    blanks are taken out again.
    """
    c = _c(col)
    spaced = F.regexp_replace(c, r"([^\p{L}])(\p{L})", "$1 $2")
    capped = F.initcap(spaced)
    return F.regexp_replace(capped, r"([^\p{L}]) (\p{L})", "$1$2")


def visit_name(col, variant: str = "capitalize", sep: str = "_") -> Column:
    """``baseline_year_1_arm_1`` -> ``baselineYear1Arm1``.

    The first part is kept, the other parts are capitalised (``capitalize``
    or ``title`` variant) and all are joined without separator.  Names of
    ASCII letters and digits are capitalised as one text, where every part is a
    word of ``initcap``; others (and for ``title`` those with a letter after a
    digit) part by part.
    """
    fn = {"capitalize": capitalize, "title": title}[variant]
    c = _c(col)
    parts = _lit_split(c, sep)
    rest = F.transform(F.slice(parts, 2, 1 << 30), lambda p: fn(p))
    by_part = F.concat(F.get(parts, 0), F.array_join(rest, ""))
    if sep != "_":
        return by_part
    plain = c.rlike(r"^[A-Za-z0-9_]*\z")
    if variant == "title":
        plain = plain & ~c.rlike("[0-9][A-Za-z]")
    first = F.substring_index(c, sep, 1)
    words = F.replace(F.substring(c, F.length(first) + 2, F.length(c)), F.lit(sep), F.lit(" "))
    return F.when(plain, F.concat(first, F.replace(F.initcap(words), F.lit(" "), F.lit("")))).otherwise(by_part)


# ------------------------------------------------------- paths
def parent_path(col) -> Column:
    """All before the last ``/``; a text without one is returned whole."""
    c = _c(col)
    return F.when(F.instr(c, "/") == 0, c).otherwise(
        F.substring(c, F.lit(1), F.length(c) - F.length(F.substring_index(c, "/", -1)) - 1))


# ------------------------------------------------- O38/O39 raw file name
def cut_at_dot(col) -> Column:
    """Text before the first ``.`` (date and time texts carry a fraction)."""
    return F.substring_index(_c(col), ".", 1)


def expected_raw_name(subject, visit, raw_type, series_date, series_time,
                      prefix: str = dims.SUBJECT_PREFIX, mark: str = dims.NAME_TYPE_MARK) -> Column:
    """``NDAR<subj>_<visit>_ABCD-<type>_<date><time>.tgz``."""
    return F.concat(F.lit(prefix), _c(subject), F.lit("_"),
                    F.replace(_c(visit), F.lit("_"), F.lit("")), F.lit("_" + mark), _c(raw_type),
                    F.lit("_"), cut_at_dot(series_date), cut_at_dot(series_time), F.lit(".tgz"))


def resolve_raw_name(found, expected) -> Column:
    """struct(name, origin): the expected name is always used (K10); the
    origin says whether a raw file was found and whether its name agreed."""
    f, e = _c(found), _c(expected)
    has = f.isNotNull() & (f != "")
    origin = F.when(~has | f.isNull(), F.lit("guessed")) \
              .when(f == e, F.lit("same")).otherwise(F.lit("different"))
    return F.struct(e.alias("name"), origin.alias("origin"))


# ------------------------------------------------------ O40 output name
def output_name(col, mark: str = dims.NAME_TYPE_MARK, new: str = dims.NAME_TYPE_NEW) -> Column:
    """Output base name: the single ``mark`` becomes ``new`` and a short
    extension (at most three characters after the last dot, the dot not
    first) is cut.  Null when the name cannot be built (E17): ``mark`` not
    found exactly once, or the only dot is the first character."""
    c = _c(col)
    parts = _lit_split(c, mark)
    joined = F.concat(F.get(parts, 0), F.lit(new), F.get(parts, 1))
    bad = (F.size(parts) != 2) | joined.rlike(r"^\.[^.]*$")
    base = F.regexp_replace(joined, r"(?<=.)\.[^.]{0,3}$", "")
    return F.when(c.isNull() | bad, F.lit(None).cast("string")).otherwise(base)


# ---------------------------------------------------- O41 dates and age
def registry_date(col) -> Column:
    """``M/d/yyyy`` -> ``MM/dd/yyyy HH:mm:ss``; null if it does not parse."""
    ts = F.try_to_timestamp(_c(col), F.lit("M/d/yyyy"))
    return F.date_format(ts, "MM/dd/yyyy HH:mm:ss")


def local_interview_date(series_date) -> Column:
    """Interview date made from the ``yyyyMMdd`` series date by slicing."""
    d = _c(series_date)
    return F.concat(F.substring(d, 5, 2), F.lit("/"), F.substring(d, 7, 2), F.lit("/"),
                    F.substring(d, 1, 4), F.lit(" 00:00:00"))


def age_months(dob, series_date, dob_fmt: str = "yyyy-MM-dd", date_fmt: str = "yyyyMMdd") -> Column:
    """Age in whole months: round(round(days / 365.25, 1) * 12); null on bad dates."""
    b = F.to_date(F.try_to_timestamp(_c(dob), F.lit(dob_fmt)))
    s = F.to_date(F.try_to_timestamp(_c(series_date), F.lit(date_fmt)))
    years = F.round(F.datediff(s, b) / F.lit(365.25), 1)
    return F.round(years * 12).cast("long")


def age_months_between(birth_date, scan_date) -> Column:
    """Same rule on two DateType columns."""
    years = F.round(F.datediff(_c(scan_date), _c(birth_date)) / F.lit(365.25), 1)
    return F.round(years * 12).cast("long")


# ------------------------------------------------------------ O43 units
def ms_to_s(col) -> Column:
    return _c(col) / F.lit(1000.0)


def radians_text(col) -> Column:
    """Degrees -> radians as ``%f`` text (the converter's flip-angle argument)."""
    return F.when(_c(col).isNotNull(), F.format_string("%f", F.radians(_c(col))))


def fixed6(col) -> Column:
    """``%f`` text of a number (the converter's TR/TE/TI arguments)."""
    return F.when(_c(col).isNotNull(), F.format_string("%f", _c(col).cast("double")))


# --------------------------------------------- Python float text (repr)
def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and use it in ``fn`` (binds a lambda variable)."""
    return F.get(F.transform(F.array(value), fn), 0)


def py_float(col) -> Column:
    """Text of a double as Python's ``repr``/``json.dumps`` writes it.

    Python writes the shortest digit string that reads back as the same
    double, in its own layout (``1e-05``, ``0.0001``, ``1e+16``).  The shortest
    string has at most 17 digits, and the correctly rounded 15-, 16- or
    17-digit form that first reads back gives exactly those digits (trailing
    zeros dropped).  Those digits are then laid out the Python way.
    NaN/inf are written as JSON does (they become null before this point).
    """
    v = _c(col).cast("double")
    c15, c16, c17 = (F.format_string(f, v) for f in ("%.14e", "%.15e", "%.16e"))
    sci_text = F.when(c15.cast("double") == v, c15).when(c16.cast("double") == v, c16).otherwise(c17)
    pat = r"^(-?)(\d)\.(\d*)e([-+]\d+)$"

    def layout(t):
        sign = F.regexp_extract(t, pat, 1)
        d0 = F.regexp_replace(F.concat(F.regexp_extract(t, pat, 2), F.regexp_extract(t, pat, 3)), "0+$", "")
        return _let(F.struct(sign.alias("s"), F.when(d0 == "", F.lit("0")).otherwise(d0).alias("d"),
                             F.regexp_extract(t, pat, 4).cast("int").alias("e")), _layout)

    # fast path: a positional JVM text (1e-3 <= |x| < 1e7) with at most 15
    # significant digits is already the shortest form, laid out as Python does
    jvm = v.cast("string")
    sig = F.regexp_replace(F.regexp_replace(F.regexp_replace(jvm, "[-.]", ""), "^0+", ""), "0+$", "")
    fast = ~jvm.contains("E") & (F.length(sig) <= 15)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(F.isnan(v), F.lit("NaN"))
             .when(v == float("inf"), F.lit("Infinity"))
             .when(v == float("-inf"), F.lit("-Infinity"))
             .when(v == 0, F.when(jvm.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
             .when(fast, jvm)
             .otherwise(_let(sci_text, layout)))


def _layout(p):
    digits, e = p["d"], p["e"]
    nd = F.length(digits)
    neg_pos = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    big_pos = F.when(nd <= e + 1, F.concat(digits, F.repeat(F.lit("0"), e + 1 - nd), F.lit(".0"))) \
               .otherwise(F.concat(F.substring(digits, 1, e + 1), F.lit("."), F.substring(digits, e + 2, 1 << 30)))
    ae = F.abs(e).cast("string")
    sci = F.concat(F.substring(digits, 1, 1),
                   F.when(nd > 1, F.concat(F.lit("."), F.substring(digits, 2, 1 << 30))).otherwise(F.lit("")),
                   F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.length(ae) < 2, F.concat(F.lit("0"), ae)).otherwise(ae))
    return F.concat(p["s"], F.when((e >= -4) & (e < 0), neg_pos)
                             .when((e >= 0) & (e < 16), big_pos).otherwise(sci))


def json_text(col) -> Column:
    """A JSON string literal of a text as Python ``json.dumps`` writes it."""
    c = F.regexp_replace(F.regexp_replace(_c(col), r"\\", r"\\\\"), '"', '\\\\"')
    short = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def escaped(ch):
        code = F.lower(F.regexp_replace(F.hex(F.encode(ch, "UTF-16BE")), "(.{4})", r"\\u$1"))
        out = F.when(ch.rlike("[^ -~]"), code).otherwise(ch)
        for k, v in short.items():
            out = F.when(ch == k, F.lit(v)).otherwise(out)
        return out
    odd = F.array_join(F.transform(F.split(c, ""), escaped), "")
    return F.concat(F.lit('"'), F.when(c.rlike(r"[^ -~]"), odd).otherwise(c), F.lit('"'))


def json_literal(text: str) -> Column:
    """``json_text`` of a constant: one literal instead of an expression."""
    return F.lit(json.dumps(text))


def json_number_list(col) -> Column:
    """A list of doubles as Python ``json.dumps`` writes it: ``[1.0, 2.5]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(col), lambda v: py_float(v)), ", "), F.lit("]"))


def json_matrix(col) -> Column:
    """A list of lists of doubles as ``json.dumps`` writes it; null -> ``[]``."""
    inner = F.transform(_c(col), lambda r: json_number_list(r))
    return F.coalesce(F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]")), F.lit("[]"))


def json_object(pairs: list[tuple[str, Column]]) -> Column:
    """``{"k": v, ...}`` with Python's default separators; values are JSON texts."""
    parts = []
    for i, (k, v) in enumerate(pairs):
        parts.append(F.lit(("" if i == 0 else ", ") + '"' + k + '": '))
        parts.append(v)
    return F.concat(F.lit("{"), *parts, F.lit("}"))
