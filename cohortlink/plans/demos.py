"""One registered query per operator of the inventory, run on the driver's
test tables (whole tables), each with its DuckDB oracle text.

Each query calls the library operator it is named after.  Where an
operator expects imaging-shaped input (nested containers, file names), the
query first shapes rows of the test tables into that schema; the shaping
only renames and packs rows, the operator does the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..functions import rules as R
from ..operators import common, files, link, nested, order, outcome, package, params, select, submit
from ..session import scratch_path
from ..sources import listing, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
OPERATOR: dict[str, str] = {}


def query(op: str, sql: str | None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        OPERATOR[fn.__name__] = op
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn
    return deco


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line_order():
    """(l_shipdate, l_linenumber, l_partkey, l_suppkey) of an order's line as one long, in that order."""
    day = F.unix_date(F.to_date("l_shipdate")).cast("long")
    return ((day * 8 + F.col("l_linenumber")) * 2 ** 24 + F.col("l_partkey")) * 2 ** 16 + F.col("l_suppkey")


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# =========================================================== 2.1 sources
@query("O01", """
select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_mktsegment from customer
""")
def cohort_read(spark, sf):
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.LongType()), T.StructField("c_mktsegment", T.StringType())])
    return readers.read_cohort(spark, f"{sf}/customer.parquet", fmt="parquet", schema=schema)


@query("O02", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
""")
def catalog_read(spark, sf):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderpriority", T.StringType())])
    return readers.read_catalog(spark, f"{sf}/orders.parquet", fmt="parquet", schema=schema)


@query("O03", """
select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id, event_type, props from events
""")
def registry_read(spark, sf):
    ev = tbl(spark, sf, "events").select(*[F.col(c).cast("string") for c in
                                           ("event_id", "user_id", "event_type", "props")])
    ev = ev.withColumns({"part": F.pmod(F.hash("event_id"), F.lit(4)), "line": F.lit(1)})
    desc = spark.createDataFrame([("id of event", "user", "type", "properties, as JSON", p, 0) for p in range(4)],
                                 ev.schema)
    path = scratch_path(spark, "registry-tsv")   # four registry files, each with its description line
    (desc.unionByName(ev).repartition(4, "part").sortWithinPartitions("part", "line").drop("line")
         .write.partitionBy("part").option("header", "true").option("sep", "\t").option("escape", '"').csv(path))
    return readers.read_registry(spark, path,
                                 columns=("event_id", "user_id", "event_type", "props")).drop("src_order")


@query("O04", """
select page_id, split_part(url, '/', -1) as name, regexp_replace(url, '/[^/]*$', '') as parent from pages
""")
def file_listing_parts(spark, sf):
    pages = tbl(spark, sf, "pages").select("page_id", F.col("url").alias("path"))
    return readers.with_path_parts(pages).select("page_id", "name", "parent")


@query("O04", """
with recursive d(path) as (
  select distinct regexp_replace(url, '/[^/]*$', '') from pages
  union
  select regexp_replace(path, '/[^/]*$', '') from d where path like '%/%')
select path from d where path <> '' and right(path, 1) not in ('/', ':')
""")
def file_listing_dirs(spark, sf):
    pages = tbl(spark, sf, "pages").select(F.col("url").alias("path"))
    listing = (readers.with_path_parts(pages)
               .select("path", "name", "parent", F.lit(False).alias("is_dir"),
                       F.lit(None).cast("long").alias("length"),
                       F.lit(None).cast("timestamp").alias("modification_time")))
    return readers.only_dirs(readers.with_directories(listing)).select("path")


@query("O04", """
select distinct o_orderstatus || '/' || cast(year(o_orderdate) as varchar) || '/' || cast(month(o_orderdate) as varchar) as folder,
       cast(1 as bigint) as n_files, true as has_bytes from orders
""")
def file_tree_listing(spark, sf):
    """Orders written to a tree of folders, the tree listed by tasks: files and bytes of each lowest folder."""
    root = scratch_path(spark, "order-tree")
    o = tbl(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"),
                                        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    o.repartition("status", "year", "month").write.partitionBy("status", "year", "month").parquet(root)
    files = listing.list_tree(spark, root).where("not is_dir")
    folder = F.regexp_replace(F.regexp_extract("parent", "(status=.*)$", 1), "[a-z]+=", "")
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), (F.min("length") > 0).alias("has_bytes"))


@query("O05", """
select l_orderkey, count(*)::bigint as n_series,
       first(l_partkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as first_part
from lineitem group by l_orderkey
""")
def containers_nested_read(spark, sf):
    nested_df = readers.nest_rows(tbl(spark, sf, "lineitem"), ["l_orderkey"],
                                  ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "series")
    path = scratch_path(spark, "containers")
    nested_df.write.parquet(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()),
                           T.StructField("series", nested_df.schema["series"].dataType)])
    c = readers.read_containers(spark, path, fmt="parquet", schema=schema)
    return c.select("l_orderkey", F.size("series").cast("long").alias("n_series"),
                    F.get("series", 0)["l_partkey"].alias("first_part"))


@query("O06", """
select s_suppkey,
       (case when s_acctbal >= 5000 then n.n_name else cast(n.n_regionkey as varchar) end) || '/' || s_name as root
from supplier, (select * from nation where n_nationkey = 7) n
""")
def project_root_paths(spark, sf):
    dim = tbl(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") >= 5000, "opt_a").otherwise("opt_b").alias("selector"),
        F.concat(F.lit("/"), F.col("s_name")).alias("suffix"))
    loc = tbl(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("ProjID"),
                                          F.col("n_name").alias("opt_a"),
                                          F.col("n_regionkey").cast("string").alias("opt_b"))
    out = readers.resolve_root(dim, loc, "7", selector="selector", suffix="suffix", options=("opt_a", "opt_b"))
    return out.select("s_suppkey", "root")


@query("O07", """
select l_orderkey, cast(l_linenumber as bigint) as t_indx, l_quantity as rot_z, l_discount as rot_x, l_tax as rot_y,
       l_extendedprice as trans_z, cast(l_partkey as double) as trans_x, cast(l_suppkey as double) as trans_y
from lineitem
""")
def motion_text_parse(spark, sf):
    li = tbl(spark, sf, "lineitem")
    text = F.concat(F.lit("  "), F.concat_ws("  ", *[F.col(c).cast("string") for c in
                    ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                     "l_partkey", "l_suppkey")], F.lit("9 \t9")))
    return readers.parse_motion(li.select("l_orderkey", text.alias("value")))


@query("O08", """
select item_id, text || chr(10) as text, cast(strlen(text) + 1 as bigint) as size from benchmark
""")
def side_text_whole(spark, sf):
    path = scratch_path(spark, "side-text")
    tbl(spark, sf, "benchmark").select("item_id", F.col("text").alias("value")) \
        .write.partitionBy("item_id").text(path)
    t = readers.read_side_text(spark, path)
    return t.select(F.col("item_id").cast("long").alias("item_id"), "text", F.col("size").cast("long"))


# ============================================== 2.2 selection and keys
def _cust_site(spark, sf):
    return tbl(spark, sf, "customer").join(
        F.broadcast(tbl(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))


@query("O09", """
select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey where n_name = 'NATION_1'
""")
def site_filter_column(spark, sf):
    return select.select_site(_cust_site(spark, sf), "NATION_1", "column", site_col="n_name") \
        .select("c_custkey", "n_name")


@query("O09", """
select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey
where strpos(concat_ws(',', c_custkey, c_name, c_mktsegment, n_name), 'NATION_1') > 0
""")
def site_filter_row(spark, sf):
    df = _cust_site(spark, sf)
    return select.select_site(df, "NATION_1", "row",
                              columns=["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name"]) \
        .select("c_custkey", "n_name")


@query("O10", """
select c_custkey, split_part(c_name, '#', 2) as subj, 'Customer#' || split_part(c_name, '#', 2) as key_sep,
       'Customer' || split_part(c_name, '#', 2) as key_nosep from customer
""")
def subject_key_parts(spark, sf):
    c = tbl(spark, sf, "customer")
    subj = R.subject_id("c_name", sep="#")
    key = R.with_prefix(subj, prefix="Customer", sep="#")
    return c.select("c_custkey", subj.alias("subj"), key.alias("key_sep"), R.without_sep(key, "#").alias("key_nosep"))


@query("O11", """
select n_nationkey, case n_name when 'NATION_0' then 'north' when 'NATION_3' then 'east'
                               when 'NATION_24' then 'last' else n_name end as alias from nation
""")
def site_alias_names(spark, sf):
    m = {"NATION_0": "north", "NATION_3": "east", "NATION_24": "last"}
    return tbl(spark, sf, "nation").select("n_nationkey", R.site_alias("n_name", m).alias("alias"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SPACECRAFT"]


@query("O12", f"""
select r_regionkey, m as modality, m in (select distinct c_mktsegment from customer) as known
from region, (values {", ".join("(" + _sq(s) + ")" for s in _SEGMENTS)}) t(m)
""")
def requests_known_modality(spark, sf):
    dim = tbl(spark, sf, "customer").select(F.col("c_mktsegment").alias("modality")).distinct()
    req = select.make_requests(tbl(spark, sf, "region").select("r_regionkey"), _SEGMENTS, dim)
    return req.select("r_regionkey", "modality", "known")


@query("O13", """
select o_orderkey, o_custkey as custkey, c_name from orders join customer on o_custkey = c_custkey
""")
def subject_catalog_match(spark, sf):
    req = tbl(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    cat = tbl(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return select.match_subject(req, cat, ["custkey"]).select("o_orderkey", "custkey", "c_name")


@query("O14", """
select event_id, event_type, case when event_type in ('click', 'view') then 'engage' else 'buy' end as family
from events where event_type in ('click', 'view', 'purchase')
""")
def type_family_match(spark, sf):
    fam = spark.createDataFrame([("engage", "click"), ("engage", "view"), ("buy", "purchase")],
                                "family string, series_type string")
    return select.match_family(tbl(spark, sf, "events"), fam, type_col="event_type", family_col="family") \
        .select("event_id", "event_type", "family")


@query("O15", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
where (l_returnflag = 'A' and l_linestatus = 'F')
   or (l_returnflag = 'N' and l_linestatus = 'O' and l_quantity * 2 >= 50)
   or (l_returnflag = 'R' and l_extendedprice / 100 >= 100)
""")
def series_quality_filter(spark, sf):
    li = tbl(spark, sf, "lineitem")
    st = F.when(F.col("l_returnflag") == "A", "MPR").when(F.col("l_returnflag") == "N", "DTI") \
          .when(F.col("l_returnflag") == "R", "BOLD")
    ty = F.when(F.col("l_linestatus") == "F", "MPR").when(F.col("l_linestatus") == "O", "DTI_b0")
    df = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", st.alias("scantype"),
                   ty.alias("SeriesType"), (F.col("l_quantity") * 2).alias("ndiffdirs"),
                   (F.col("l_extendedprice") / 100).alias("nreps"))
    return select.filter_series(df).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# =================================================== 2.3 nested data
_LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query("O16", """
select l_orderkey, row_number() over (partition by l_orderkey
         order by l_linenumber, l_partkey, l_suppkey, l_quantity) as series_index, l_linenumber, l_partkey
from lineitem
""")
def series_positions(spark, sf):
    c = readers.nest_rows(tbl(spark, sf, "lineitem"), ["l_orderkey"], _LINE_FIELDS, "series")
    out = nested.explode_series(c, "series", keep=["l_orderkey"])
    return out.select("l_orderkey", F.col("series_index").cast("long"), "l_linenumber", "l_partkey")


@query("O17", """
select event_id, case when event_type = 'click' then value * 2 else value end as TR from events
""")
def scan_attributes_last_wins(spark, sf):
    ev = tbl(spark, sf, "events").withColumn("day", F.to_date("ts"))
    c = readers.nest_rows(ev, ["user_id", "day"], ["event_id", "event_type", "value"], "series",
                          order=["ts", "event_id"])
    idx = F.sequence(F.lit(1), F.size("series"))
    val = lambda i: F.get(F.col("series"), i - 1)["value"]
    typ = lambda i: F.get(F.col("series"), i - 1)["event_type"]
    clicks = F.filter(idx, lambda i: typ(i) == "click")
    group = lambda t, ix, v: F.struct(F.lit(t).alias("type"), ix.alias("series_index"), v.alias("TR"))  # noqa
    scans = F.array(group("MPR", idx, F.transform(idx, val)),
                    group("BOLD", clicks, F.transform(clicks, lambda i: val(i) * 2)),
                    group("FMAP", idx, F.transform(idx, lambda i: F.lit(-1.0))))
    c = c.withColumn("__entries", nested.scan_entries(scans, ["TR"]))
    s = nested.explode_series(c, "series", keep=["user_id", "day", "__entries"])
    return s.select("event_id", nested.last_attr("__entries", "series_index", "TR").alias("TR"))


@query("O18", """
select l_orderkey, row_number() over (partition by l_orderkey order by l_returnflag, l_linenumber) as scan_number,
       cast(l_linenumber as bigint) as series_index
from lineitem
""")
def scan_numbers_two_level(spark, sf):
    li = tbl(spark, sf, "lineitem")
    groups = li.groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list("l_linenumber")).alias("idx"))
    typ = F.when(F.col("l_returnflag") == "A", "BOLD").when(F.col("l_returnflag") == "N", "DTI").otherwise("MPR")
    packed = F.array_sort(F.collect_list(F.struct("l_returnflag", typ.alias("type"), F.col("idx").alias("series_index"))))
    cont = groups.groupBy("l_orderkey").agg(packed.alias("g")) \
        .select("l_orderkey", F.transform("g", lambda x: F.struct(x["type"].alias("type"),
                                                                   x["series_index"].alias("series_index"))).alias("scans"))
    out = nested.number_scans(cont, "scans", keep=["l_orderkey"])
    return out.select("l_orderkey", F.col("scan_number").cast("long"), F.col("series_index").cast("long"))


@query("O19", """
select event_id, cast(json_extract_string(props, '$.k') as double) as k from events
""")
def private_value_json(spark, sf):
    return tbl(spark, sf, "events").select("event_id", R.private_value("props", "$.k").alias("k"))


@query("O20", """
select l_orderkey, count(distinct l_suppkey) as n_patients,
       count(distinct case when l_returnflag in ('A', 'R') then l_returnflag end) as n_accepted
from lineitem group by l_orderkey
""")
def container_profile_suppliers(spark, sf):
    li = tbl(spark, sf, "lineitem")
    typ = F.when(F.col("l_returnflag") == "A", "MPR").when(F.col("l_returnflag") == "R", "DTI").otherwise("FMAP")
    c = li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_suppkey").alias("PatientID"), "l_linenumber")).alias("series"),
        F.array_distinct(F.collect_list(F.struct(typ.alias("type")))).alias("scans"))
    return nested.container_profile(c).select("l_orderkey", "n_patients", "n_accepted")


# ========================================================== 2.4 joins
def _family():
    return F.when(F.col("event_type").isin("click", "view"), F.lit("engage")).otherwise(F.col("event_type"))


@query("O21", """
select event_id, printf('Run-%02d', row_number() over (
  partition by user_id, case when event_type in ('click', 'view') then 'engage' else event_type end
  order by ts, event_id)) as run_key from events
""")
def run_key_order(spark, sf):
    ev = tbl(spark, sf, "events").withColumn("family", _family())
    return order.run_order(ev, ["user_id", "family"], ["ts", "event_id"]).select("event_id", "run_key")


@query("O22", """
select l_orderkey as key, l_linenumber, l_linestatus as ci_status, o_orderstatus as pc_status, o_orderpriority
from lineitem join orders on l_orderkey = o_orderkey
""")
def catalog_join_qualified(spark, sf):
    s = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber",
                                          F.col("l_linestatus").alias("status"))
    c = tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
                                        "o_orderpriority")
    return order.join_catalog(s, c, "key").select("key", "l_linenumber", "ci_status", "pc_status", "o_orderpriority")


@query("O23", """
with c as (select l_orderkey, count(*) as n_catalog from lineitem group by 1),
j as (select l_orderkey, bool_and(coalesce(year(l_shipdate) = year(o_orderdate), false)) as times_ok,
             count(*) as n_joined
      from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R' group by 1)
select c.l_orderkey, coalesce(j.times_ok, true) as times_ok, coalesce(j.n_joined, 0) as n_joined, c.n_catalog,
       coalesce(j.n_joined, 0) <> c.n_catalog as count_differs, coalesce(j.n_joined, 0) > 2 as too_many
from c left join j on c.l_orderkey = j.l_orderkey
""")
def series_time_check(spark, sf):
    li = tbl(spark, sf, "lineitem")
    joined = li.where(F.col("l_returnflag") == "R").join(tbl(spark, sf, "orders"),
                                                         F.col("l_orderkey") == F.col("o_orderkey"))
    out = order.check_series(joined, li, ["l_orderkey"], F.year("l_shipdate"), F.year("o_orderdate"))
    return out.select("l_orderkey", "times_ok", "n_joined", "n_catalog", "count_differs", "too_many")


def _proc_prefix():
    return (F.when(F.col("l_returnflag") == "R", "MRIPROC").when(F.col("l_returnflag") == "A", "DTIPROC")
             .otherwise("MRIPROCX"))
_PROC_PREFIX_SQL = "(case l_returnflag when 'R' then 'MRIPROC' when 'A' then 'DTIPROC' else 'MRIPROCX' end)"


@query("O24", f"""
with f as (select distinct l_orderkey,
             '/proc/' || {_PROC_PREFIX_SQL} || '_S' || l_suppkey || '_INV' || l_orderkey || '_' || l_linenumber as path
           from lineitem where l_returnflag in ('R', 'N'))
select o_orderkey, count(f.path) as container_n, case when count(f.path) = 1 then min(f.path) end as container,
       case when count(f.path) = 0 then 'missing' when count(f.path) = 1 then 'one' else 'many' end as container_status
from orders left join f on f.l_orderkey = o_orderkey group by o_orderkey
""")
def container_lookup(spark, sf):
    li = tbl(spark, sf, "lineitem")
    name = F.concat(_proc_prefix(), F.lit("_S"), F.col("l_suppkey").cast("string"), F.lit("_INV"),
                    F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
    listing = li.select(F.concat(F.lit("/proc/"), name).alias("path"), name.alias("name"),
                        F.lit("/proc").alias("parent"), F.lit(True).alias("is_dir"))
    req = tbl(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("INV"), F.col("o_orderkey").cast("string"))
                                          .alias("subject"), F.lit("/proc/MRI").alias("root"))
    out = files.find_container(req, listing, keys=["o_orderkey"])
    return out.select("o_orderkey", "container_n", "container", "container_status")


@query("O25", """
select o_orderkey, coalesce(n, 0) as v_n, case when n = 1 then v end as v,
       case when n is null then 'missing' when n = 1 then 'one' else 'many' end as v_status
from orders left join (select l_orderkey, count(*) as n, min(l_partkey) as v from lineitem
                       where l_quantity >= 45 group by 1) on l_orderkey = o_orderkey
""")
def cardinality_guard(spark, sf):
    base = tbl(spark, sf, "orders").select("o_orderkey")
    cand = tbl(spark, sf, "lineitem").where(F.col("l_quantity") >= 45) \
        .select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return common.cardinality(base, cand, ["o_orderkey"], "l_partkey", "v").select("o_orderkey", "v_n", "v", "v_status")


@query("O26", """
select o_custkey, o_orderkey
from (select *, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 end as rk from orders)
where rk is not null qualify rk = min(rk) over (partition by o_custkey)
""")
def first_pattern_fallback(spark, sf):
    o = tbl(spark, sf, "orders")
    rk = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2)
    return files.first_pattern(o, ["o_custkey"], rk).select("o_custkey", "o_orderkey")


def _prefix_by_type():
    return (F.when(F.col("p_type") == "ECONOMY", "small").when(F.col("p_type") == "SMALL", "red")
             .otherwise("large"))
_PREFIX_BY_TYPE_SQL = "(case p_type when 'ECONOMY' then 'small' when 'SMALL' then 'red' else 'large' end)"


@query("O27", f"""
with r as (select distinct p_brand as container, p_type, {_PREFIX_BY_TYPE_SQL} as pre from part),
c as (select r.container, r.p_type, f.p_brand || '/' || f.p_partkey as path from r
      join part f on f.p_brand = r.container and starts_with(f.p_name, r.pre))
select r.container, r.p_type, count(c.path) as image_n, case when count(c.path) = 1 then min(c.path) end as image,
       case when count(c.path) = 0 then 'missing' when count(c.path) = 1 then 'one' else 'many' end as image_status
from r left join c on c.container = r.container and c.p_type = r.p_type group by r.container, r.p_type
""")
def structural_image_lookup(spark, sf):
    p = tbl(spark, sf, "part")
    runs = p.select(F.col("p_brand").alias("container"), "p_type", _prefix_by_type().alias("struct_prefix")).distinct()
    listing = p.select(F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("path"),
                       F.col("p_name").alias("name"), F.col("p_brand").alias("parent"), F.lit(False).alias("is_dir"))
    out = files.structural_files(runs, listing, ["container", "p_type"], prefixes=["small", "red", "large"])
    return out.select("container", "p_type", "image_n", "image", "image_status")


def _pick_sql(name: str, cond: str) -> str:
    n = f"count(*) filter (where {cond})"
    return (f"{n} as {name}_n, case when {n} = 1 then min(cast(event_id as varchar)) filter (where {cond}) end as {name}, "
            f"case when {n} = 0 then 'missing' when {n} = 1 then 'one' else 'many' end as {name}_status")


@query("O28", f"""
select user_id, {_pick_sql('click', "event_type = 'click'")}, {_pick_sql('buy', "event_type = 'purchase'")},
       {_pick_sql('err', "event_type = 'error'")}
from events group by user_id
""")
def functional_file_pick(spark, sf):
    ev = tbl(spark, sf, "events")
    runs = ev.select("user_id").distinct()
    fl = ev.select(F.col("user_id").alias("parent"), F.col("event_id").cast("string").alias("path"), "event_type")
    picks = {"click": F.col("event_type") == "click", "buy": F.col("event_type") == "purchase",
             "err": F.col("event_type") == "error"}
    out = files.pick_files(runs, fl, ["user_id"], [("user_id", "parent")], picks)
    return out.select("user_id", *[c for n in picks for c in (n + "_n", n, n + "_status")])


_BOLD_NAME_SQL = ("'BOLD' || l_linenumber || (case l_returnflag when 'R' then '_for_corr_resBOLD.mgz' "
                  "when 'A' then '_for_corr_resBOLD_motion.1D' else '_for_f0_corr_resBOLD_regT1.mat' end)")


@query("O28", f"""
with f as (select distinct '/b/' || l_orderkey as dir, l_linenumber as sn, l_returnflag as flag,
                  '/b/' || l_orderkey || '/' || {_BOLD_NAME_SQL} as path from lineitem),
r as (select distinct '/b/' || l_orderkey as container, l_linenumber as scan_number from lineitem),
g as (select dir, count(*) as regis_n, min(path) as reg from f where flag = 'N' group by dir),
p as (select r.container, r.scan_number,
             count(*) filter (where f.flag = 'R') as image_n, min(f.path) filter (where f.flag = 'R') as im,
             count(*) filter (where f.flag = 'A') as motion_n, min(f.path) filter (where f.flag = 'A') as mo
      from r left join f on f.dir = r.container and f.sn = r.scan_number group by 1, 2)
select p.container, cast(p.scan_number as bigint) as scan_number, p.image_n, case when p.image_n = 1 then im end as image,
       p.motion_n, case when p.motion_n = 1 then mo end as motion, coalesce(g.regis_n, 0) as regis_n,
       case when g.regis_n = 1 then g.reg end as regis
from p left join g on g.dir = p.container
""")
def functional_scan_files(spark, sf):
    li = tbl(spark, sf, "lineitem")
    suffix = (F.when(F.col("l_returnflag") == "R", dims.BOLD_IMAGE_INFIX)
               .when(F.col("l_returnflag") == "A", dims.BOLD_MOTION_INFIX).otherwise(dims.BOLD_REG_SUFFIXES[1]))
    name = F.concat(F.lit("BOLD"), F.col("l_linenumber").cast("string"), suffix)
    d = F.concat(F.lit("/b/"), F.col("l_orderkey").cast("string"))
    listing = li.select(F.concat(d, F.lit("/"), name).alias("path"), name.alias("name"), d.alias("parent"),
                        F.lit(False).alias("is_dir")).distinct()
    runs = li.select(d.alias("container"), F.col("l_linenumber").alias("scan_number")).distinct()
    out = files.functional_files(runs, listing, ["container", "scan_number"])
    return out.select("container", F.col("scan_number").cast("long"), "image_n", "image", "motion_n", "motion",
                      "regis_n", "regis")


@query("O29", """
with p as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as t
           from events where event_type = 'purchase'),
v as (select user_id, row_number() over (partition by user_id order by ts, event_id) as o
      from events where event_type = 'view')
select p.event_id, coalesce(min('/u/' || p.user_id || '/stim_MID/MID_run' || v.o || '_events.tsv'), '') as event,
       count(v.o) as event_n
from p left join v on v.user_id = p.user_id and v.o = p.t group by p.event_id
""")
def event_file_nth(spark, sf):
    ev = tbl(spark, sf, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    runs = (ev.where(F.col("event_type") == "purchase")
              .select("event_id", F.concat(F.lit("/u/"), F.col("user_id").cast("string")).alias("container"),
                      F.lit("MID").alias("task"), F.row_number().over(w).alias("t_ord")))
    views = ev.where(F.col("event_type") == "view").select("user_id", F.row_number().over(w).alias("o"))
    folder = F.concat(F.lit("/u/"), F.col("user_id").cast("string"), F.lit("/stim_MID"))
    name = F.concat(F.lit("MID_run"), F.col("o").cast("string"), F.lit("_events.tsv"))
    listing = views.select(F.concat(folder, F.lit("/"), name).alias("path"), name.alias("name"),
                           folder.alias("parent"), F.lit(False).alias("is_dir"))
    out = files.event_files(runs, listing, ["event_id"], tasks=["MID", "SST", "nBack"])
    return out.select("event_id", "event", "event_n")


_DTI_NAME_SQL = "(case l_returnflag when 'R' then 'data.nii.gz' when 'A' then 'bvals.txt' else 'bvecs.txt' end)"
_REG_NAME_SQL = ("'DTI' || l_linenumber || (case when l_tax = 0 then '_rev' else '' end) || '_corr_regT1_regT1.mat'")


@query("O30", f"""
with f as (select distinct '/d/' || l_orderkey as dir, l_linenumber as sn, {_DTI_NAME_SQL} as name,
                  '/d/' || l_orderkey || '/exportDTIforFSL/DTI' || l_linenumber || '/' || {_DTI_NAME_SQL} as path
           from lineitem),
g0 as (select distinct '/d/' || l_orderkey as dir, '/d/' || l_orderkey || '/' || {_REG_NAME_SQL} as path
       from lineitem where l_linestatus = 'F'),
g as (select dir, count(*) as regmtx_n, min(path) as regmtx from g0 where strpos(path, 'rev') = 0 group by dir),
r as (select distinct '/d/' || l_orderkey as container, l_linenumber as scan_number from lineitem),
p as (select r.container, r.scan_number,
             count(*) filter (where strpos(f.name, '.nii.gz') > 0) as image_n,
             count(*) filter (where strpos(f.name, 'bvals') > 0) as bvals_n,
             count(*) filter (where strpos(f.name, 'bvecs') > 0) as bvecs_n
      from r left join f on f.dir = r.container and f.sn = r.scan_number group by 1, 2)
select p.container, cast(p.scan_number as bigint) as scan_number, p.image_n, p.bvals_n, p.bvecs_n,
       coalesce(g.regmtx_n, 0) as regmtx_n, g.regmtx
from p left join g on g.dir = p.container
""")
def diffusion_file_pick(spark, sf):
    li = tbl(spark, sf, "lineitem")
    d = F.concat(F.lit("/d/"), F.col("l_orderkey").cast("string"))
    dname = (F.when(F.col("l_returnflag") == "R", "data.nii.gz").when(F.col("l_returnflag") == "A", "bvals.txt")
              .otherwise("bvecs.txt"))
    sub = F.concat(d, F.lit("/exportDTIforFSL/DTI"), F.col("l_linenumber").cast("string"))
    dti = li.select(F.concat(sub, F.lit("/"), dname).alias("path"), dname.alias("name"), sub.alias("parent"))
    rname = F.concat(F.lit("DTI"), F.col("l_linenumber").cast("string"),
                     F.when(F.col("l_tax") == 0, "_rev").otherwise(""), F.lit(dims.DTI_REG_SUFFIX))
    reg = li.where(F.col("l_linestatus") == "F").select(F.concat(d, F.lit("/"), rname).alias("path"),
                                                         rname.alias("name"), d.alias("parent"))
    listing = dti.unionByName(reg).distinct().withColumn("is_dir", F.lit(False))
    runs = li.select(d.alias("container"), F.col("l_linenumber").alias("scan_number")).distinct()
    out = files.diffusion_files(runs, listing, ["container", "scan_number"], registration=None)
    return out.select("container", F.col("scan_number").cast("long"), "image_n", "bvals_n", "bvecs_n",
                      "regmtx_n", "regmtx")


@query("O31", """
select p_partkey, case when upper(p_name || ' ' || p_type) like '%GE%' then 1
                       when upper(p_name || ' ' || p_type) like '%PH%' then 2
                       when upper(p_name || ' ' || p_type) like '%SI%' then 1 end::bigint as lim from part
""")
def maker_image_limit(spark, sf):
    return tbl(spark, sf, "part").select(
        "p_partkey", R.max_images(F.concat_ws(" ", "p_name", "p_type")).cast("long").alias("lim"))


_P = dims.SUBJECT_PREFIX
_RAW_NAME_SQL = (f"'{_P}C' || o_custkey || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || "
                 "(case when o_orderpriority = '1-URGENT' then 'NORM' else 'STD' end) || '_' || o_orderkey || '.tgz'")


@query("O32", f"""
with r as (select o_orderkey as k, o_custkey as c, strftime(o_orderdate, '%Y%m%d') as d, o_orderstatus = 'F' as pref
           from orders),
f as (select o_custkey as c, strftime(o_orderdate, '%Y%m%d') as d,
             '/fast-track/' || o_orderstatus || '/' || {_RAW_NAME_SQL} as path, o_orderpriority = '1-URGENT' as norm
      from orders),
c as (select r.k, (r.pref and f.norm)::int as flag, f.path from r join f on f.c = r.c and f.d = r.d),
c2 as (select * from c qualify flag = max(flag) over (partition by k))
select r.k as o_orderkey, count(c2.path) as raw_n, case when count(c2.path) = 1 then min(c2.path) end as raw,
       case when count(c2.path) = 0 then 'missing' when count(c2.path) = 1 then 'one' else 'many' end as raw_status,
       split_part(case when count(c2.path) = 1 then min(c2.path) end, '/', -1) as raw_name
from r left join c2 on c2.k = r.k group by r.k
""")
def raw_file_match(spark, sf):
    o = tbl(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    runs = o.select("o_orderkey", F.concat(F.lit(_P + "C"), F.col("o_custkey").cast("string")).alias("raw_subject"),
                    day.alias("series_time"), (F.col("o_orderstatus") == "F").alias("prefer_mark"))
    name = F.concat(F.lit(_P + "C"), F.col("o_custkey").cast("string"), F.lit("_"), day, F.lit("_"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", "NORM").otherwise("STD"), F.lit("_"),
                    F.col("o_orderkey").cast("string"), F.lit(".tgz"))
    parent = F.concat(F.lit("/fast-track/"), F.col("o_orderstatus"))
    listing = o.select(F.concat(parent, F.lit("/"), name).alias("path"), name.alias("name"), parent.alias("parent"),
                       F.lit(False).alias("is_dir"))
    out = files.match_raw(runs, listing, ["o_orderkey"], "/fast-track")
    return out.select("o_orderkey", "raw_n", "raw", "raw_status", "raw_name")


@query("O33", """
select o_custkey, o_orderkey from orders
qualify (o_orderpriority = '1-URGENT')::int = max((o_orderpriority = '1-URGENT')::int) over (partition by o_custkey)
""")
def prefer_marked(spark, sf):
    o = tbl(spark, sf, "orders")
    return files.prefer_if_any(o, ["o_custkey"], (F.col("o_orderpriority") == "1-URGENT").cast("int")) \
        .select("o_custkey", "o_orderkey")


@query("O34", """
select o_orderkey, f.first_part, f.l_orderkey is not null as raw_found from orders
left join (select l_orderkey, first(l_partkey order by l_linenumber, l_partkey, l_suppkey) as first_part
           from lineitem group by 1) f on f.l_orderkey = o_orderkey
""")
def merge_raw_side(spark, sf):
    proc = tbl(spark, sf, "orders").select("o_orderkey")
    raw = (tbl(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
           .agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f"))
           .select("o_orderkey", F.col("f.l_partkey").alias("first_part")))
    return files.merge_runs(proc, raw, ["o_orderkey"]).select("o_orderkey", "first_part", "raw_found")


@query("O35", """
select l_orderkey, l_linenumber,
       case when l_returnflag = 'R' then coalesce(case when l_discount > 0 then l_discount * 100 end,
                                                  case when l_tax > 0 then l_tax * 1000 end) end as TI,
       (l_returnflag = 'R' and not (l_discount > 0) and l_tax > 0) as ti_private_used
from lineitem
""")
def params_ti_fallback(spark, sf):
    li = tbl(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "T1").otherwise("T2").alias("modality"),
        F.when(F.col("l_discount") > 0, F.col("l_discount") * 100).otherwise(F.lit(float("nan"))).alias("TI"),
        F.when(F.col("l_tax") > 0, F.col("l_tax") * 1000).alias("TIpriv"))
    return params.attach_params(li, ti_present=None).select("l_orderkey", "l_linenumber", "TI", "ti_private_used")


@query("O36", """
select o_orderkey, pk, case when k is null then 'no_subject' when n is null then 'no_file'
                            when n > 1 then 'linked_last' else 'linked' end as st
from orders
left join (select l_orderkey, count(*) over (partition by l_orderkey) as n, l_partkey as pk
           from lineitem where l_returnflag = 'R'
           qualify row_number() over (partition by l_orderkey
             order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc) = 1)
       on l_orderkey = o_orderkey
left join (select distinct l_orderkey as k from lineitem) on k = o_orderkey
""")
def registry_last_match(spark, sf):
    runs = tbl(spark, sf, "orders").select("o_orderkey", F.lit("R").alias("file"))
    reg = tbl(spark, sf, "lineitem")
    out = link.link_registry(runs, reg, "o_orderkey", "file", ["l_partkey"], reg_subject="l_orderkey",
                             reg_file=F.col("l_returnflag"),
                             order=line_order())
    return out.select("o_orderkey", F.col("rec.l_partkey").alias("pk"), F.col("link_status").alias("st"))


# =================================================== 2.5 column rules
@query("O37", """
select o_orderkey,
  split_part(o_orderpriority, '-', 1) || upper(substr(split_part(o_orderpriority, '-', 2), 1, 1))
    || lower(substr(split_part(o_orderpriority, '-', 2), 2)) as cap,
  split_part(o_orderpriority, '-', 1) || array_to_string(list_transform(string_split(split_part(o_orderpriority, '-', 2), ' '),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') as ttl
from orders
""")
def visit_name_variants(spark, sf):
    return tbl(spark, sf, "orders").select(
        "o_orderkey", R.visit_name("o_orderpriority", "capitalize", sep="-").alias("cap"),
        R.visit_name("o_orderpriority", "title", sep="-").alias("ttl"))


@query("O38", f"""
select o_orderkey, '{_P}C' || o_custkey || '_' || replace(lower(replace(o_orderpriority, ' ', '_')), '_', '')
       || '_{dims.NAME_TYPE_MARK}' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m%d') || o_orderkey || '.tgz' as expected
from orders
""")
def expected_raw_names(spark, sf):
    o = tbl(spark, sf, "orders")
    name = R.expected_raw_name(F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
                               F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("_"))), F.col("o_orderstatus"),
                               F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".0")),
                               F.concat(F.col("o_orderkey").cast("string"), F.lit("."), F.col("o_custkey").cast("string")))
    return o.select("o_orderkey", name.alias("expected"))


@query("O39", r"""
select page_id, regexp_extract(url, '/(\d+)', 1) as name,
  case when nullif(regexp_extract(url, '(\d+)$', 1), '') is null then 'guessed'
       when regexp_extract(url, '(\d+)$', 1) = regexp_extract(url, '/(\d+)', 1) then 'same' else 'different' end as origin
from pages
""")
def raw_name_resolution(spark, sf):
    p = tbl(spark, sf, "pages")
    found = F.nullif(F.regexp_extract("url", r"(\d+)$", 1), F.lit(""))
    r = R.resolve_raw_name(found, F.regexp_extract("url", r"/(\d+)", 1))
    return p.select("page_id", r["name"].alias("name"), r["origin"].alias("origin"))


@query("O40", r"""
select page_id, case when len(string_split(url, '/en/')) = 2
   and not regexp_matches(split_part(url, '/en/', 1) || '/en-mproc/' || split_part(url, '/en/', 2), '^\.[^.]*$')
  then regexp_replace(split_part(url, '/en/', 1) || '/en-mproc/' || split_part(url, '/en/', 2), '^(.+)\.[^.]{0,3}$', '\1')
  end as out_name
from pages
""")
def output_base_names(spark, sf):
    return tbl(spark, sf, "pages").select("page_id", R.output_name("url", "/en/", "/en-mproc/").alias("out_name"))


@query("O41", """
select o_orderkey, strftime(o_orderdate, '%m/%d/%Y') || ' 00:00:00' as idate,
       strftime(o_orderdate, '%m/%d/%Y') || ' 00:00:00' as ldate,
       round(round(date_diff('day', date '1988-02-29', o_orderdate::date) / 365.25, 1) * 12)::bigint as age_m
from orders
""")
def interview_dates_age(spark, sf):
    o = tbl(spark, sf, "orders")
    return o.select("o_orderkey", R.registry_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("idate"),
                    R.local_interview_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("ldate"),
                    R.age_months(F.lit("1988-02-29"), F.date_format("o_orderdate", "yyyyMMdd")).alias("age_m"))


@query("O42", f"""
with reg as (select cast(l_orderkey as varchar) as subjectkey, l_returnflag || '.tgz' as f,
                    case when l_tax = 0 then '' else cast(l_suppkey as varchar) end as dataset_id,
                    strftime(l_shipdate, '%m/%d/%Y') || ' 00:00:00' as idate, cast(l_linenumber * 12 as varchar) as age,
                    's3://b/' || l_returnflag || '.tgz' as image_file, cast(l_partkey as varchar) as image03_id,
                    l_shipdate, l_linenumber, l_partkey, l_suppkey, l_tax
             from lineitem),
last as (select * from reg where f = 'R.tgz'
         qualify row_number() over (partition by subjectkey
           order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_tax desc) = 1)
select o_orderkey,
       case when last.subjectkey is null then '0' else coalesce(nullif(trim(last.dataset_id), ''), '0') end as origin_dataset_id,
       case when last.subjectkey is null then strftime(o_orderdate, '%m/%d/%Y') || ' 00:00:00' else last.idate end as interview_date,
       case when last.subjectkey is null
            then cast(round(round(date_diff('day', date '1988-02-29', o_orderdate::date) / 365.25, 1) * 12)::bigint as varchar)
            else last.age end as interview_age,
       case when last.subjectkey is null then '{dims.RAW_BUCKET}{_P}' || o_orderkey || '.tgz' else last.image_file end as file_source,
       case when last.subjectkey is null then '' else last.image03_id end as img03_id
from orders left join last on last.subjectkey = cast(o_orderkey as varchar)
""")
def source_choice(spark, sf):
    li = tbl(spark, sf, "lineitem")
    reg = li.select(F.col("l_orderkey").cast("string").alias("subjectkey"),
                    F.concat(F.lit("s3://b/"), F.col("l_returnflag"), F.lit(".tgz")).alias("image_file"),
                    F.when(F.col("l_tax") == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("dataset_id"),
                    F.date_format("l_shipdate", "M/d/yyyy").alias("interview_date"),
                    (F.col("l_linenumber") * 12).cast("string").alias("interview_age"),
                    F.col("l_partkey").cast("string").alias("image03_id"),
                    line_order().alias("src_order"))
    runs = tbl(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("subject"), F.lit("R.tgz").alias("file"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("series_date"), F.lit("1988-02-29").alias("dob"),
        F.concat(F.lit(_P), F.col("o_orderkey").cast("string"), F.lit(".tgz")).alias("raw_resolved"))
    linked = link.link_registry(runs, reg, "subject", "file",
                                ["image03_id", "dataset_id", "interview_date", "interview_age", "image_file"])
    out = link.choose_source(linked)
    return out.select("o_orderkey", "origin_dataset_id", "interview_date", "interview_age", "file_source", "img03_id")


@query("O43", """
select l_orderkey, l_linenumber, l_extendedprice / 1000 as tr_s, printf('%f', l_extendedprice / 1000) as te,
  printf('%f', radians(l_discount * 100)) as fa
from lineitem
""")
def units_text(spark, sf):
    return tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             R.ms_to_s("l_extendedprice").alias("tr_s"),
                                             R.fixed6(R.ms_to_s("l_extendedprice")).alias("te"),
                                             R.radians_text(F.col("l_discount") * 100).alias("fa"))


# ============================================ 2.6 outputs and outcomes
@query("O44a", """
select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
""")
def existing_package_guard(spark, sf):
    runs = tbl(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("package"))
    existing = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"))
    kept, _ = package.drop_existing(runs, existing)
    return kept.select("o_orderkey")


_SES_SQL = ("split_part(p_name, ' ', 1) || upper(substr(split_part(p_name, ' ', 2), 1, 1)) "
            "|| lower(substr(split_part(p_name, ' ', 2), 2))")


@query("O44b", f"""
select p_partkey, 'sub-P' || p_partkey || '/ses-' || {_SES_SQL} || '/'
  || (case p_type when 'ECONOMY' then 'anat' when 'SMALL' then 'anat' when 'MEDIUM' then 'dwi' else 'func' end)
  || '/sub-P' || p_partkey || '_ses-' || {_SES_SQL}
  || (case p_type when 'PROMO' then '_task-mid' when 'STANDARD' then '_task-sst' when 'LARGE' then '_task-rest' else '' end)
  || '_run-' || printf('%02d', p_size) as bids_base
from part
""")
def bids_name_parts(spark, sf):
    p = tbl(spark, sf, "part")
    st = (F.when(F.col("p_type") == "ECONOMY", "MPR").when(F.col("p_type") == "SMALL", "XetaT2")
           .when(F.col("p_type") == "MEDIUM", "DTI").otherwise("BOLD"))
    task = (F.when(F.col("p_type") == "PROMO", "mid").when(F.col("p_type") == "STANDARD", "sst")
             .when(F.col("p_type") == "LARGE", "rest").otherwise(""))
    runs = p.select("p_partkey", F.concat(F.lit("P_"), F.col("p_partkey").cast("string")).alias("pGUID"),
                    F.replace("p_name", F.lit(" "), F.lit("_")).alias("event_rc"), st.alias("scantype"),
                    task.alias("bids_task"), order.run_key(F.col("p_size")).alias("run_key"))
    from ..dims import scantype_dim
    return package.bids_parts(runs, scantype_dim(spark)).select("p_partkey", "bids_base")


@query("O44c", """
select o_orderkey, (row_number() over (partition by o_orderkey order by p) - 1)::bigint as pos, arcname, kind from (
  select o_orderkey, 0 as p, 'a-' || o_orderkey || '.nii' as arcname, 'image' as kind from orders
  union all select o_orderkey, 1, 'a-' || o_orderkey || '.tsv', 'events' from orders where o_orderstatus = 'F'
  union all select o_orderkey, 2, 'a-' || o_orderkey || '.json', 'json' from orders)
""")
def manifest_members(spark, sf):
    o = tbl(spark, sf, "orders")
    k = F.col("o_orderkey").cast("string")
    members = [package.member(F.concat(F.lit("a-"), k, F.lit(".nii")), "image"),
               package.member(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("a-"), k, F.lit(".tsv"))), "events"),
               package.member(F.concat(F.lit("a-"), k, F.lit(".json")), "json")]
    return package.member_rows(o, ["o_orderkey"], members).select("o_orderkey", "pos", "arcname", "kind")


def _d(x: str) -> str:
    return f"cast(({x})::double as varchar)"


@query("O44d", f"""
select n_nationkey, case n_regionkey
  when 1 then '{{"RepetitionTime": ' || {_d('n_nationkey * 100 / 1000')} || ', "EchoTime": ' || {_d('n_nationkey * 2.5 / 1000')}
     || ', "FlipAngle": ' || {_d('8 + n_regionkey')} || '}}'
  when 2 then '{{"TaskName": "mid", "registration_matrix_T1": [[1.0, 0.5], [' || {_d('n_nationkey')} || ', 0.25]], '
     || '"RepetitionTime": ' || {_d('n_nationkey * 100 / 1000')} || ', "EchoTime": ' || {_d('n_nationkey * 2.5 / 1000')}
     || ', "FlipAngle": ' || {_d('8 + n_regionkey')} || '}}'
  when 3 then '{{"registration_matrix_T1": [], "IntendedFor": "sub-N' || n_nationkey || '_ses-x_run-01_dwi.nii", '
     || '"RepetitionTime": ' || {_d('n_nationkey * 100 / 1000')} || ', "EchoTime": ' || {_d('n_nationkey * 2.5 / 1000')}
     || ', "FlipAngle": ' || {_d('8 + n_regionkey')} || '}}'
  else '{{"RepetitionTime": ' || {_d('n_nationkey * 100 / 1000')} || ', "EchoTime": ' || {_d('n_nationkey * 2.5 / 1000')}
     || ', "FlipAngle": ' || {_d('8 + n_regionkey')} || ', "InversionTime": ' || {_d('(1000 + n_nationkey) / 1000')} || '}}'
  end as side_json
from nation
""")
def side_json_text(spark, sf):
    n = tbl(spark, sf, "nation")
    st = (F.when(F.col("n_regionkey") == 1, "XetaT2").when(F.col("n_regionkey") == 2, "BOLD")
           .when(F.col("n_regionkey") == 3, "DTI").otherwise("MPR"))
    k = F.col("n_nationkey").cast("double")
    mtx = F.when(F.col("n_regionkey") == 2, F.array(F.array(F.lit(1.0), F.lit(0.5)), F.array(k, F.lit(0.25))))
    runs = n.select("n_nationkey", st.alias("scantype"), (k * 100).alias("TR"), (k * 2.5).alias("TE"),
                    (F.col("n_regionkey") + 8).cast("double").alias("FlipAngle"), (k + 1000).alias("TI"),
                    mtx.alias("reg_matrix"), F.lit("mid").alias("bids_task"),
                    F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("bids_sub"),
                    F.lit("x").alias("bids_ses"), F.lit("run-01").alias("bids_run"), F.lit("_dwi").alias("bids_suffix"))
    return runs.select("n_nationkey", package.side_json(runs).alias("side_json"))


def _py_sql(x: str) -> str:
    return f"cast(({x})::double as varchar)"


@query("O44e", f"""
select l_orderkey, 't_indx' || chr(9) || 'rot_z' || chr(9) || 'rot_x' || chr(9) || 'rot_y' || chr(9) || 'trans_z'
  || chr(9) || 'trans_x' || chr(9) || 'trans_y' || chr(10)
  || string_agg(l_linenumber || chr(9) || {_py_sql('l_quantity')} || chr(9) || {_py_sql('l_discount')} || chr(9)
                || {_py_sql('l_tax')} || chr(9) || {_py_sql('l_extendedprice')} || chr(9) || l_partkey || chr(9) || l_suppkey,
                chr(10) order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_extendedprice)
  || chr(10) as tsv
from lineitem group by l_orderkey
""")
def motion_table_text(spark, sf):
    li = tbl(spark, sf, "lineitem")
    cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in
                              ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                               "l_partkey", "l_suppkey")], F.lit("2 9"))
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*cols, line.alias("line")))).alias("a"))
    text = F.array_join(F.transform("a", lambda x: x["line"]), "\n")
    return per.select("l_orderkey", package.motion_tsv(text).alias("tsv"))


_SESSION = {m: det for m, *_, det in dims.MODALITY_ROWS}


def _submission_sql() -> str:
    lit = _sq
    vals = {
        "subjectkey": f"'{_P}_C' || o_custkey", "src_subject_id": f"'{_P}_C' || o_custkey",
        "origin_dataset_id": "'0'", "interview_date": "strftime(o_orderdate, '%m/%d/%Y') || ' 00:00:00'",
        "interview_age": "cast(o_custkey as varchar)",
        "gender": "case when o_orderstatus = 'F' then 'F' else 'M' end",
        "experiment_id": "case when o_orderpriority = '1-URGENT' then '648' else '' end",
        "inputs": lit(dims.INPUTS_TEXT), "img03_id": "cast(o_orderkey as varchar)",
        "file_source": f"'{dims.RAW_BUCKET}x' || o_orderkey || '.tgz'", "job_name": "''", "proc_types": "''",
        "metric_files": "''", "pipeline": lit(dims.PIPELINE), "pipeline_script": lit(dims.PIPELINE_SCRIPT),
        "pipeline_tools": lit(dims.PIPELINE_TOOLS), "pipeline_type": lit(dims.PIPELINE_TYPE),
        "pipeline_version": lit(dims.PIPELINE_VERSION), "qc_fail_quest_reason": "''", "qc_outcome": lit(dims.QC_OUTCOME),
        "derived_files": lit(dims.RELEASE_BUCKET) + " || 'B' || o_orderkey || '.tgz'",
        "scan_type": "case when o_orderstatus = 'F' then 'fMRI' else 'MR structural (T1)' end",
        "img03_id2": "''", "file_source2": "''",
        "session_det": f"case when o_orderstatus = 'F' then {lit(_SESSION['fMRI_MID_task'])} else {lit(_SESSION['T1'])} end",
        "image_history": f"case when o_orderstatus = 'F' then {lit(dims.IMAGE_HISTORY_BOLD)} "
                         f"else {lit(dims.IMAGE_HISTORY_STRUCT)} end",
    }
    return "select o_orderkey, " + ", ".join(f"{vals[c]} as {c}" for c in dims.SUBMISSION_COLUMNS) + " from orders"


@query("O45a", _submission_sql())
def submission_record(spark, sf):
    o = tbl(spark, sf, "orders")
    is_f = F.col("o_orderstatus") == "F"
    pg = F.concat(F.lit(_P + "_C"), F.col("o_custkey").cast("string"))
    cols = submit.submission_columns(
        pg, F.lit("0"), F.date_format("o_orderdate", "MM/dd/yyyy 00:00:00"), F.col("o_custkey").cast("string"),
        F.when(is_f, "F").otherwise("M"), F.when(F.col("o_orderpriority") == "1-URGENT", "648").otherwise(""),
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit(dims.RAW_BUCKET + "x"), F.col("o_orderkey").cast("string"), F.lit(".tgz")),
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")),
        F.when(is_f, "fMRI").otherwise("MR structural (T1)"),
        F.when(is_f, _SESSION["fMRI_MID_task"]).otherwise(_SESSION["T1"]),
        F.when(is_f, dims.IMAGE_HISTORY_BOLD).otherwise(dims.IMAGE_HISTORY_STRUCT))
    return o.select("o_orderkey", *cols)


@query("O45b", """
select n_nationkey, 'n_name' as name, n_name as value from nation
union all select n_nationkey, 'n_regionkey', cast(n_regionkey as varchar) from nation
""")
def payload_rows(spark, sf):
    return submit.name_value_rows(tbl(spark, sf, "nation"), ["n_nationkey"], ["n_name", "n_regionkey"])


@query("O45b", f"""
select n_nationkey, '{{"schemaName": "{dims.SCHEMA_NAME}", "dataStructureRows": [{{"shortName": "{dims.SHORT_NAME}", '
  || '"dataElement": [{{"name": "n_name", "value": "' || n_name || '"}}, {{"name": "n_regionkey", "value": "'
  || n_regionkey || '"}}]}}]}}' as payload
from nation
""")
def payload_document(spark, sf):
    return submit.payload(tbl(spark, sf, "nation"), ["n_nationkey"], columns=["n_name", "n_regionkey"])


_TYPED_SQL = """
with v as (select s_suppkey,
    cast(s_suppkey as varchar) as w,
    case when s_suppkey % 10 = 3 then null else cast(s_nationkey as varchar) end as g,
    case when s_nationkey % 2 = 0 then 'True' else 'false' end as b,
    case when s_suppkey % 7 = 0 then 'n' || s_nationkey else cast(s_nationkey as varchar) end as t from supplier),
k as (select
    case when bool_and(coalesce(regexp_full_match(w, '[+-]?[0-9]+'), false)) then 'whole' else 'other' end as wk,
    case when bool_and(g is null or regexp_full_match(g, '[+-]?[0-9]+')) and bool_or(g is null) then 'float'
         when bool_and(g is not null and regexp_full_match(g, '[+-]?[0-9]+')) then 'whole' else 'other' end as gk,
    case when bool_and(b in ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) then 'boolean' else 'other' end as bk,
    case when bool_or(not regexp_full_match(t, '[+-]?[0-9]+')) then 'text' else 'whole' end as tk from v)
"""


@query("O45b", _TYPED_SQL + """
select wk as w, gk as g, bk as b, tk as t from k
""")
def registry_column_types(spark, sf):
    return submit.column_types(_typed_texts(spark, sf), ["w", "g", "b", "t"])


@query("O45b", _TYPED_SQL + f"""
select s_suppkey, '{{"schemaName": "{dims.SCHEMA_NAME}", "dataStructureRows": [{{"shortName": "{dims.SHORT_NAME}", '
  || '"dataElement": [{{"name": "w", "value": ' || case when wk = 'whole' then w else '"' || w || '"' end
  || '}}, {{"name": "g", "value": ' || case when g is null then 'NaN' when gk = 'float' then g || '.0' else g end
  || '}}, {{"name": "b", "value": ' || case when bk = 'boolean' then lower(b) else '"' || b || '"' end
  || '}}, {{"name": "t", "value": ' || case when tk = 'text' then '"' || t || '"' else t end || '}}]}}]}}' as payload
from v, k
""")
def payload_typed_document(spark, sf):
    rows, cols = _typed_texts(spark, sf), ["w", "g", "b", "t"]
    typed = rows.withColumn("kinds", submit.column_types(rows, cols).select(F.struct("*")).scalar())
    return submit.payload(typed, ["s_suppkey"], columns=cols,
                          values={c: submit.json_value(F.col(c), F.col("kinds")[c]) for c in cols})


def _typed_texts(spark, sf):
    """Text columns of suppliers: whole numbers, whole numbers with gaps, truth values, a mixture."""
    nation = F.col("s_nationkey").cast("string")
    return tbl(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_suppkey").cast("string").alias("w"),
        F.when(F.col("s_suppkey") % 10 != 3, nation).alias("g"),
        F.when(F.col("s_nationkey") % 2 == 0, "True").otherwise("false").alias("b"),
        F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("n"), nation)).otherwise(nation).alias("t"))


@query("O46a", f"""
with s as (select user_id, arg_max(value > 20, ts) as ok, arg_max(props, ts) as msg from events
           where event_type = 'view' group by 1),
u as (select user_id, arg_max(value > 20, ts) as ok, arg_max(props, ts) as msg from events
      where event_type = 'purchase' group by 1),
r as (select distinct user_id from events)
select r.user_id, coalesce(s.ok, false) as submit_ok,
       regexp_replace(coalesce(s.msg, ''), '["'']', '', 'g') as submit_msg,
       case when coalesce(s.ok, false) then coalesce(u.ok, false) end as upload_ok,
       case when coalesce(s.ok, false) then regexp_replace(coalesce(u.msg, ''), '["'']', '', 'g')
            else {_sq(dims.UPLOAD_SKIPPED_MSG)} end as upload_msg,
       not coalesce(s.ok, false) or not coalesce(case when coalesce(s.ok, false) then coalesce(u.ok, false) end, false)
         as withdrawn
from r left join s on s.user_id = r.user_id left join u on u.user_id = r.user_id
""")
def delivery_outcomes(spark, sf):
    ev = tbl(spark, sf, "events")
    runs = ev.select("user_id").distinct()
    replies = (ev.where(F.col("event_type").isin("view", "purchase"))
                 .select("user_id", F.when(F.col("event_type") == "view", "submit").otherwise("upload").alias("step"),
                         (F.col("value") > 20).alias("ok"), F.col("props").alias("msg"), F.col("ts").alias("reply_order")))
    out = outcome.outcomes(runs, replies, ["user_id"])
    return out.select("user_id", "submit_ok", "submit_msg", "upload_ok", "upload_msg", "withdrawn")


@query("O46b", """
select sha256(concat_ws('|', cast(s_suppkey as varchar), '2026-01-01T00:00:00')) as id, cast(s_suppkey as varchar) as s_suppkey,
       s_name, cast(s_acctbal as varchar) as s_acctbal, case when s_acctbal > 5000 then 'True' else 'False' end as rich,
       cast(s_nationkey as bigint) as s_nationkey
from supplier
""")
def ledger_text_roundtrip(spark, sf):
    s = tbl(spark, sf, "supplier").withColumn("rich", F.col("s_acctbal") > 5000)
    rows = outcome.ledger_rows(s, ["s_suppkey"], "2026-01-01T00:00:00", partition_cols=["s_nationkey"])
    path = scratch_path(spark, "ledger")
    outcome.append_ledger(rows, path, partition_cols=["s_nationkey"])
    back = spark.read.parquet(path)
    return back.select("id", "s_suppkey", "s_name", "s_acctbal", "rich", F.col("s_nationkey").cast("long"))


@query("O46c", """
select o_orderkey, 'R01' as code, 'error' as severity, 'request' as scope from orders where o_totalprice > 400000
union all select o_orderkey, 'R02', 'warning', 'run' from orders where o_orderstatus = 'P'
union all select o_orderkey, 'R03', 'warning', 'run' from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'
""")
def issue_rule_codes(spark, sf):
    o = tbl(spark, sf, "orders")
    rules = [("R01", "error", "request", F.col("o_totalprice") > 400000),
             ("R02", "warning", "run", F.col("o_orderstatus") == "P"),
             ("R03", "warning", "run", (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"))]
    return common.tag_issues(o, ["o_orderkey"], rules).select("o_orderkey", "code", "severity", "scope")


@query("O46d", """
select event_id, max((event_type = 'error')::int) over (partition by user_id order by ts, event_id
  rows between unbounded preceding and current row) = 1 as failed from events
""")
def fail_fast_running(spark, sf):
    runs = tbl(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    issues = common.tag_issues(runs, ["user_id", "event_id"],
                               [("E", "error", "run", F.col("event_type") == "error"),
                                ("W", "warning", "run", F.col("event_type") == "view")])
    return outcome.fail_fast(runs, issues, ["user_id"], ["user_id", "event_id"], "at").select(
        "event_id", F.col("blocked").alias("failed"))


@query("O46e", """
select event_type, strftime(ts, '%Y-%m-%d') as d, grouping(event_type, strftime(ts, '%Y-%m-%d')) as grouping_id,
  count(*) as n, count(*) filter (where value > 50) as k
from events group by rollup(event_type, strftime(ts, '%Y-%m-%d'))
""")
def summary_rollup(spark, sf):
    ev = tbl(spark, sf, "events").withColumn("d", F.date_format("ts", "yyyy-MM-dd"))
    return outcome.summarize(ev, ["event_type", "d"], {"k": F.col("value") > 50})
