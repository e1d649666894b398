"""Registered plans: each operator of the package applied to the shared
driver tables. Every callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over whole tables; column names match ``cathlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cathlake.operators import episodes
from cathlake.sources.tables import read_table

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- mappings
# lineitem as a catalog of studies: study = order, image time = ship date,
# label N -> 0, R -> 1, A -> 2, "modality XA" = line status F.
def _li_label():
    f = F.col("l_returnflag")
    return F.when(f == "N", 0).when(f == "R", 1).when(f == "A", 2)


LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
           "l_returnflag", "l_linestatus"]


# events as a catalog: study = user, label click -> 1, view -> 0, else 2.
def _ev_label():
    t = F.col("event_type")
    return F.when(t == "click", 1).when(t == "view", 0).otherwise(2)


# ------------------------------------------------------------ K6 flagship
@register("diagnostic_flag")
def diagnostic_flag(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(*LI_COLS)
    return episodes.flag_diagnostic(li, entry="l_orderkey", ts="l_shipdate",
                                    label=_li_label(),
                                    where=F.col("l_linestatus") == "F")


@register("diagnostic_flag_events")
def diagnostic_flag_events(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return episodes.flag_diagnostic(ev, entry="user_id", ts="ts", label=_ev_label())


@register("leading_runs")
def leading_runs(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return episodes.leading_runs(ev, "user_id", "ts", _ev_label(), targets=(1, 0))


# ------------------------------------------------------------ K7
@register("runs_v1")
def runs_v1(spark: SparkSession, d: str) -> DataFrame:
    cv = read_table(spark, d, "conversations").select(
        "conv_id", "turn", "role", F.when(F.col("role") == "user", 1).otherwise(0).alias("label"))
    ones = episodes.leading_runs_v1(cv, "conv_id", "turn", "label", 1)
    zeros = episodes.leading_runs_v1(cv, "conv_id", "turn", "label", 0)
    return (ones.withColumn("target", F.lit(1))
            .unionByName(zeros.withColumn("target", F.lit(0))))


# ------------------------------------------------------------ building blocks
@register("group_extremum")
def group_extremum(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return episodes.group_extremum(ev, "user_id", "ts", F.col("event_type"), "click")


@register("corr_min")
def corr_min(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return episodes.before_first(ev, "user_id", "ts", F.col("event_type") == "purchase")


@register("uniform_groups")
def uniform_groups(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_type")
    return episodes.uniform_groups(ev, ["user_id", "day"], "event_type")


@register("distinct_entry")
def distinct_entry(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("user_id", "event_type").distinct()


@register("series_expand")
def series_expand(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_partkey", "p_size")
    return episodes.series_expand(p, F.lit(1), F.col("p_size") - 40, "n")


# ------------------------------------------------------------ numbering
from cathlake.operators import numbering, setjoin, upsert  # noqa: E402

LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
          "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
          "l_shipdate"]


@register("rank_ts")
def rank_ts(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"))
    return numbering.group_rank(ev, ["user_id"], ["day"], "rank", "rank")


@register("dense_rank_day")
def dense_rank_day(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"))
    return numbering.group_rank(ev, ["user_id"], ["day"], "drank", "dense_rank")


@register("row_number_ts")
def row_number_ts(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts")
    return numbering.group_rank(ev, ["user_id"], ["ts"], "rn", "row_number",
                                tiebreak=["event_id"])


@register("serial_ids")
def serial_ids(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(*LI_ALL)
    return numbering.dense_ids(li, LI_ALL, "rowid", start=0)


@register("dedup_key")
def dedup_key(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select(*LI_ALL)
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return numbering.keep_first(li, ["l_orderkey", "l_linenumber"], order)


@register("batch_assign")
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    """Split the part list into 8 work batches of ceil(n / 8) consecutive rows."""
    p = read_table(spark, d, "part").select("p_partkey", "p_name")
    return numbering.work_batches(p, ["p_partkey"], 8)


@register("dup_groups")
def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return (li.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
            .where(F.col("n") > 1))


# ------------------------------------------------------------ set joins
def _cust_keys(spark, d):
    c = read_table(spark, d, "customer")
    return c.select("c_custkey", "c_name",
                    F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_custkey")).alias("ckey"))


@register("anti_not_in")
def anti_not_in(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return setjoin.not_in(_cust_keys(spark, d), o, "ckey", "o_custkey")


@register("anti_not_in_null")
def anti_not_in_null(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_custkey")).alias("k"))
    return setjoin.not_in(_cust_keys(spark, d), o, "ckey", "k")


TUPLE_KEYS = ["k1", "k2", "k3", "k4"]


def _tuple_sides(spark, d):
    li = read_table(spark, d, "lineitem")
    left = li.select(F.col("l_orderkey").alias("k1"),
                     F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_partkey")).alias("k2"),
                     F.col("l_suppkey").alias("k3"), F.col("l_linenumber").alias("k4"),
                     "l_shipdate")
    right = li.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select(
        F.col("l_orderkey").alias("k1"), F.col("l_partkey").alias("k2"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_suppkey")).alias("k3"),
        F.col("l_linenumber").alias("k4"))
    return left, right


@register("anti_tuple")
def anti_tuple(spark: SparkSession, d: str) -> DataFrame:
    left, right = _tuple_sides(spark, d)
    return setjoin.not_in_tuple(left, right, TUPLE_KEYS)


@register("semi_in")
def semi_in(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return setjoin.semi_in(o, li, ["o_orderkey"], ["l_orderkey"])


@register("union_distinct")
def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    click = F.coalesce(F.col("event_type") == "click", F.lit(False))
    parts = [ev.where(c).select("user_id", F.to_date("ts").alias("day")) for c in (click, ~click)]
    return setjoin.union_distinct(*parts)


@register("union_all")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"))
    return setjoin.union_all(c, s)


# ------------------------------------------------------------ K2 upsert
ORD_KEYS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority"]


def _orders_catalog(spark, d, lo=None, hi=None, tag="a"):
    o = read_table(spark, d, "orders")
    if lo is not None:
        o = o.where(F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        o = o.where(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
    return o.select(
        (F.col("o_orderkey") * 2).alias("rowid"), "o_custkey", "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority", "o_orderdate",
        F.concat(F.lit(f"/{tag}/"), F.col("o_orderkey").cast("string")).alias("path"))


@register("catalog_upsert")
def catalog_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Base = orders placed before 1997, staging = orders from 1996 on with a
    new path; 1996 overlaps."""
    base = _orders_catalog(spark, d, hi="1997-01-01", tag="a")
    stg = _orders_catalog(spark, d, lo="1996-01-01", tag="b")
    return upsert.upsert_catalog(base, stg, ORD_KEYS, refresh=["path"],
                                 order=["o_orderdate", "o_orderkey"])


# ------------------------------------------------------------ K4 linkage
from cathlake.operators import cohort, labels, linkage, registry  # noqa: E402


@register("link_window")
def link_window(spark: SparkSession, d: str) -> DataFrame:
    """Each error event with the nearest purchase of the same user within
    +-6 h (inclusive), or NULLs."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value", "event_type")
    err = ev.where(F.col("event_type") == "error").drop("event_type")
    pur = ev.where(F.col("event_type") == "purchase").drop("event_type")
    return linkage.link_window(err, pur, "user_id", "user_id", "ts", "ts", "event_id",
                               lid=["event_id"], hours=6,
                               rcols=["event_id", "ts", "value"], unique_left=True)


@register("link_window_dup")
def link_window_dup(spark: SparkSession, d: str) -> DataFrame:
    """As ``link_window`` over all events but purchases, with an image id that
    several of them share: the survivor carries its own match."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value", "event_type")
    pur = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    img = ev.where(~pur).select((F.col("event_id") % 997).alias("image"), "user_id", "ts", "event_id")
    return linkage.link_window(img, ev.where(pur).drop("event_type"), "user_id", "user_id", "ts", "ts", "event_id",
                               lid=["image"], hours=6, rcols=["event_id", "ts", "value"])


# ------------------------------------------------------------ K3 registry
@register("registry_wide")
def registry_wide(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as a long registry: entry = order, site = line number 1-7,
    measures quantity / discount / return flag (min per site), attributes
    from the entry's first line."""
    li = read_table(spark, d, "lineitem")
    return registry.pivot_measures(
        li, ["l_orderkey"], "l_linenumber", list(range(1, 8)),
        {"l_quantity": "qty_", "l_discount": "disc_", "l_returnflag": "flag_"},
        reducer="min", order=["l_linenumber", "l_partkey", "l_suppkey"],
        attrs=["l_shipdate", "l_linestatus"])


@register("registry_first")
def registry_first(spark: SparkSession, d: str) -> DataFrame:
    """Same registry with the ``first`` reducer: the value of the first row
    (by part, supplier, ship date) among duplicate (entry, site) rows."""
    li = read_table(spark, d, "lineitem")
    return registry.pivot_measures(
        li, ["l_orderkey"], "l_linenumber", list(range(1, 8)),
        {"l_quantity": "qty_"}, reducer="first",
        order=["l_partkey", "l_suppkey", "l_shipdate", "l_quantity"])


@register("pivot_conflicts")
def pivot_conflicts(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return registry.pivot_conflicts(li, ["l_orderkey"], "l_linenumber")


@register("cardinality_profile")
def cardinality_profile(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return registry.cardinality_profile(
        li, ["l_orderkey"], ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                             "l_linestatus", "l_shipdate"])


# ------------------------------------------------------------ K8 cohort
def _orders_as_catalog(spark, d):
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderstatus").alias("Modality"),
        F.col("o_custkey").cast("string").alias("PatientID"),
        F.when(F.col("o_orderpriority").startswith("5"), None)
         .otherwise(F.col("o_orderpriority")).alias("StudyInstanceUID"),
        F.when(F.col("o_totalprice") > 400000, None)
         .otherwise(F.concat(F.lit("/f/"), F.col("o_orderkey").cast("string"))).alias("DcmPathFlatten"))


@register("cohort_counts")
def cohort_counts(spark: SparkSession, d: str) -> DataFrame:
    return cohort.cohort_report(_orders_as_catalog(spark, d), modalities=("F", "O", "P"), main="F")


@register("exclusion_report")
def exclusion_report(spark: SparkSession, d: str) -> DataFrame:
    """Loops and patients of the full catalog missing from the transformed
    one (here: orders up to a total price of 300 000)."""
    full = _orders_as_catalog(spark, d)
    kept = read_table(spark, d, "orders").where(F.col("o_totalprice") <= 300000).select(
        F.concat(F.lit("/f/"), F.col("o_orderkey").cast("string")).alias("DcmPathFlatten"))
    return cohort.exclusion_report(full, kept)


@register("funnel")
def funnel(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    return cohort.funnel(ev, {
        "n_candidates": F.lit(True),
        "n_valid": F.get_json_object("props", "$.k").isNotNull(),
        "n_transformable": F.col("event_type") != "error",
    })


@register("cohort_phase")
def cohort_phase(spark: SparkSession, d: str) -> DataFrame:
    """Orders of customers on the cohort list (automobile segment) go to the
    test phase, the rest keep 'train'."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", F.lit("train").alias("phase"))
    ids = read_table(spark, d, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    return labels.assign_phase(o, ids, key="o_custkey", id_col="c_custkey")


# ------------------------------------------------------------ K5 / K11
@register("label_merge")
def label_merge(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.lit(None).cast("int").alias("quality"))
    ann = read_table(spark, d, "labels")
    return labels.merge_annotations(docs, ann, keys=["doc_id"], values=["quality", "toxic"])


@register("synth_labels")
def synth_labels(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", "user_id")
    return labels.synthetic_labels(ev, id_col="event_id", seed=7,
                                   float_cols=["sten_proc_1_prox_rca_transformed"])


# ------------------------------------------------------------ scalar normalisers
from cathlake.functions import normalize as N  # noqa: E402
from cathlake.functions import paths as P  # noqa: E402
from cathlake.functions.schema import catalog_types, conform  # noqa: E402
from cathlake.sources import headers, readers, sinks  # noqa: E402


def _time_raw():
    ts, t = F.col("ts"), F.col("event_type")
    hms = F.date_format(ts, "HHmmss")
    return (F.when(t == "view", (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("string"))
            .when(t == "purchase", F.lit(""))
            .when(t == "click", F.concat(hms, F.lit(".123")))
            .when(t == "signup", F.hour(ts).cast("string"))
            .otherwise(hms))


@register("time_norm")
def time_norm(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_id", _time_raw().alias("t_raw"))
    return ev.select("event_id", "t_raw", N.time_text("t_raw").alias("t_text"),
                     N.time_prefix("t_raw").alias("t_prefix"), N.pad_left("t_raw", 6).alias("t_pad"))


@register("num_norm")
def num_norm(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    s = (F.when(t == "error", F.lit("None")).when(t == "view", F.lit(""))
         .when(t == "signup", F.lit("NaT"))
         .when(t == "click", F.concat(F.floor("value").cast("string"), F.lit(".7")))
         .otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string"))))
    ev = read_table(spark, d, "events").select("event_id", s.alias("s"))
    return ev.select("event_id", "s", N.to_long("s").alias("as_long"), N.to_double("s").alias("as_double"))


def _date_raw():
    ts, t = F.col("ts"), F.col("event_type")
    ymd = F.date_format(ts, "yyyyMMdd")
    return (F.when(t == "error", F.lit("")).when(t == "signup", F.concat(ymd, F.lit(".0")))
            .when((t == "view") & (F.col("value") > 45), F.lit("20240230"))
            .otherwise(ymd))


def _series_time():
    ts, t = F.col("ts"), F.col("event_type")
    hms = F.date_format(ts, "HHmmss")
    return (F.when(t == "view", (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("string"))
            .when(t == "purchase", F.lit("None"))
            .when(t == "click", F.concat(hms, F.lit(".5")))
            .otherwise(hms))


@register("ts_combine")
def ts_combine(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select(
        "event_id", _date_raw().alias("date_s"), _series_time().alias("time_s"))
    return ev.withColumn("TimeStamp", N.combine_ts("date_s", "time_s"))


@register("text_clean")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    doc = read_table(spark, d, "documents")
    return doc.select("doc_id", N.clean_text("text").alias("text_clean"))


@register("text_export")
def text_export(spark: SparkSession, d: str) -> DataFrame:
    doc = read_table(spark, d, "documents")
    return doc.select("doc_id", N.export_text("text").alias("text_export"))


# ------------------------------------------------------------ paths
@register("path_build")
def path_build(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "P", None)
        .otherwise(F.col("o_orderstatus")).alias("status"), "o_orderpriority")
    p = o.withColumn("path", P.hierarchical_path("/data", "o_custkey", "o_orderkey", "status",
                                                 "o_orderpriority"))
    return p.select("o_orderkey", "path", P.output_path("/out", "path").alias("out_path"),
                    P.flattened_name("o_orderkey", "path").alias("flat_name"))


@register("path_relative")
def path_relative(spark: SparkSession, d: str) -> DataFrame:
    pg = read_table(spark, d, "pages").select("page_id", "url")
    rel = pg.withColumn("rel", P.relative_to("url", "example"))
    return rel.where(F.col("rel").isNotNull())


def _customer_paths(spark, d):
    c = read_table(spark, d, "customer")
    marked = F.concat(F.lit("/data/"), F.col("c_name"), F.lit("/DICOM/"),
                      F.col("c_custkey").cast("string"), F.lit(".dcm"))
    plain = F.concat(F.lit("/data/"), F.col("c_name"), F.lit("/"),
                     F.col("c_custkey").cast("string"), F.lit(".dcm"))
    return c.select("c_custkey", F.when(F.col("c_mktsegment") != "HOUSEHOLD", marked)
                    .otherwise(plain).alias("path"),
                    F.col("c_custkey").cast("string").alias("PatientID"))


@register("path_patient")
def path_patient(spark: SparkSession, d: str) -> DataFrame:
    c = _customer_paths(spark, d)
    return c.withColumn("PatientID", P.repair_key("PatientID", "path"))


# ------------------------------------------------------------ sources / sinks
CUSTOMER_TYPES = {"c_custkey": "serial PRIMARY KEY", "c_name": "varchar(255)",
                  "c_nationkey": "int8", "c_acctbal": "float8", "c_mktsegment": "varchar(255)",
                  "c_phone": "varchar(255)", "c_active": "BOOLEAN", "c_since": "TIMESTAMP"}


@register("scan_project")
def scan_project(spark: SparkSession, d: str) -> DataFrame:
    return conform(read_table(spark, d, "customer"), CUSTOMER_TYPES)


@register("sql_source")
def sql_source(spark: SparkSession, d: str) -> DataFrame:
    q = """
      SELECT r.r_name, n.n_name, count(c.c_custkey) AS n_customers
      FROM cl_nation n JOIN cl_region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN cl_customer c ON c.c_nationkey = n.n_nationkey
      GROUP BY r.r_name, n.n_name"""
    return readers.sql_source(spark, q, {
        "cl_nation": read_table(spark, d, "nation"), "cl_region": read_table(spark, d, "region"),
        "cl_customer": read_table(spark, d, "customer")})


@register("ctas_copy")
def ctas_copy(spark: SparkSession, d: str) -> DataFrame:
    import uuid
    root, name = sinks.shared_table_root(spark), f"part_{uuid.uuid4().hex[:8]}"
    return sinks.create_as(read_table(spark, d, "part"), "cag", name, f"{root}/cag/{name}")


@register("sparse_header")
def sparse_header(spark: SparkSession, d: str) -> DataFrame:
    ev = headers.parse_json_records(read_table(spark, d, "events"), "props")
    return headers.project_map(ev, "header", {"k": "int8", "source": "varchar(255)"},
                               keep=["event_id"])


@register("sort_limit")
def sort_limit(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(10)


# ------------------------------------------------------------ K3 registry (faithful modes)
def _lineitem_registry(spark, d):
    """lineitem in the registry's long shape (all strings): patient = order,
    entry = order + line status, sub-entry = supplier id as text (string
    order), site = segment name by line number (line 7: NULL site), rows
    with a zero tax have no procedure start."""
    li = read_table(spark, d, "lineitem")
    site_names = F.array(*[F.lit(v) for v in registry.SITES])
    return li.select(
        F.col("l_orderkey").cast("string").alias("bth_pid"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linestatus")).alias("entryid"),
        F.when(F.col("l_tax") == 0, None).otherwise(F.lit("2000-01-01 00:00:00"))
         .alias("procedurestart_lokalbed_velse"),
        F.col("l_suppkey").cast("string").alias("sub_entryid"),
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.element_at(site_names, F.col("l_linenumber")))
         .alias("proceduresite"),
        F.col("l_quantity").cast("string").alias("stenosegrad_eyeball"),
        F.col("l_discount").cast("string").alias("ffr"),
        F.col("l_returnflag").alias("kartype"),
        F.when(F.col("l_discount") > 0.07, None).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"),
        "l_linenumber")


@register("registry_entry")
def registry_entry(spark: SparkSession, d: str) -> DataFrame:
    return registry.registry_wide(_lineitem_registry(spark, d), mode="entry", order=["l_linenumber"])


@register("registry_sub_entry")
def registry_sub_entry(spark: SparkSession, d: str) -> DataFrame:
    return registry.registry_wide(_lineitem_registry(spark, d), mode="sub_entry", order=["l_linenumber"])


@register("tsv_ingest")
def tsv_ingest(spark: SparkSession, d: str) -> DataFrame:
    """part written as a header TSV to the shared folder, read back with every
    column a string (no inference), then conformed to typed columns."""
    import uuid
    path = f"{sinks.shared_table_root(spark)}/tsv/part_{uuid.uuid4().hex[:8]}"
    sinks.write_csv(read_table(spark, d, "part"), path, sep="\t")
    raw = readers.read_tsv(spark, path)
    return conform(raw, {"p_partkey": "int8", "p_name": "varchar(255)", "p_brand": "varchar(255)",
                         "p_size": "int8", "p_retailprice": "float8"})


# ------------------------------------------------------------ K1 catalog build
from cathlake.operators import catalog as cat_ops  # noqa: E402

BUILD_COLS = ["rowid", "DcmPathFlatten", "StudyDate", "TimeStamp", "DateStamp", "SeriesTime",
              "Modality", "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID",
              "NumberOfFrames"]
KEY4 = cat_ops.KEY4


def _event_records(spark, d):
    """events as header records: one file per event under /archive/base/,
    header attributes as strings (error events have no study date)."""
    ev = headers.parse_json_records(read_table(spark, d, "events"), "props")
    hdr = F.create_map(
        F.lit("PatientID"), F.col("user_id").cast("string"),
        F.lit("StudyInstanceUID"), F.date_format("ts", "yyyyMMdd"),
        F.lit("SeriesInstanceUID"), F.col("event_type"),
        F.lit("SOPInstanceUID"), F.element_at("header", F.lit("k")),
        F.lit("StudyDate"), F.when(F.col("event_type") == "error", F.lit(""))
                             .otherwise(F.date_format("ts", "yyyyMMdd")),
        F.lit("SeriesTime"), F.concat(F.date_format("ts", "HHmmss"), F.lit(".5")),
        F.lit("Modality"), F.when(F.col("event_type") == "error", F.lit("OT")).otherwise(F.lit("XA")),
        F.lit("NumberOfFrames"), F.concat(F.floor("value").cast("string"), F.lit(".0")))
    path = F.concat(F.lit("/archive/base/"), F.col("user_id").cast("string"), F.lit("/"),
                    F.col("event_id").cast("string"), F.lit(".dcm"))
    return ev.select(path.alias("path"), hdr.alias("header"))


@register("catalog_build")
def catalog_build(spark: SparkSession, d: str) -> DataFrame:
    """Header records -> relative paths -> header columns -> timestamps ->
    one row per 4-part key (first by path) -> typed columns in dictionary
    order -> dense ids in path order."""
    types = {c: t for c, t in catalog_types().items() if c in BUILD_COLS}
    built, _rejects = cat_ops.build_catalog(_event_records(spark, d), types, base_folder="base")
    return built


# ------------------------------------------------------------ E1 under heavy ties
@register("rank_ties")
def rank_ties(spark: SparkSession, d: str) -> DataFrame:
    """A handful of groups, a third of the times NULL: ties and groups of any weight."""
    day = F.when(F.col("event_id") % 3 != 0, F.to_date("ts"))
    ev = read_table(spark, d, "events").select("event_id", "event_type", day.alias("day"))
    ranked = numbering.group_rank(ev, ["event_type"], ["day"], "rank", "rank")
    return numbering.group_rank(ranked, ["event_type"], ["day"], "drank", "dense_rank")


# ------------------------------------------------------------ typed loads and their rejects
from cathlake.sources import permissive  # noqa: E402


def _fresh_path(spark, name):
    import uuid
    return f"{sinks.shared_table_root(spark)}/{name}_{uuid.uuid4().hex[:8]}"


@register("csv_ingest")
def csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    """documents as CSV cells with quotes, separators, line breaks, outer spaces and
    missing-value tokens, read back cell by cell and typed."""
    t = F.col("lang")
    cells = read_table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit(' "'), F.col("text"), F.lit('", \n'), t, F.lit(" ")).alias("text"),
        F.when(t == "fr", "NA").when(t == "de", "NULL").when(t == "es", "n/a").otherwise(F.col("source")).alias("source"),
        F.when(t == "fr", "#N/A").when(t == "de", F.concat(F.col("n_chars").cast("string"), F.lit(".9")))
         .otherwise(F.col("n_chars").cast("string")).alias("n_chars"))
    path = _fresh_path(spark, "csv/documents")
    sinks.write_csv(cells, path)
    rows, _rejects = permissive.read_records(spark, path, cells.columns)
    return conform(rows, {"doc_id": "int8", "text": "TEXT", "source": "varchar(255)", "n_chars": "int8"})


@register("reject_counts")
def reject_counts(spark: SparkSession, d: str) -> DataFrame:
    """Values that do not fit their column's type, counted while the table is written."""
    t = F.col("event_type")
    raw = read_table(spark, d, "events").select(
        F.when(t == "error", "None").when(t == "view", "").when(t == "signup", "NaT")
         .when(t == "click", F.concat(F.floor("value").cast("string"), F.lit(".7")))
         .otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string"))).alias("NumberOfFrames"),
        F.when(t == "click", "12,5").when(t == "view", "NA").otherwise(F.col("value").cast("string")).alias("FrameTime"),
        F.when(t == "signup", "2024-13-45 00:00:00").when(t == "error", "NaT")
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("TimeStamp"), F.col("user_id").cast("string").alias("PatientID"))
    types = {c: t for c, t in catalog_types().items() if c in ("NumberOfFrames", "FrameTime", "TimeStamp", "PatientID")}
    _table, counts = permissive.load_counted(raw, types, _fresh_path(spark, "loads/events"))
    return counts


@register("registry_typed")
def registry_typed(spark: SparkSession, d: str) -> DataFrame:
    """One row per (sub-entry, site), the strict pivot (none may repeat), ids and typed columns."""
    one = numbering.keep_first(_lineitem_registry(spark, d),
                               ["bth_pid", "entryid", "procedurestart_lokalbed_velse", "sub_entryid", "proceduresite"],
                               ["l_linenumber", "stenosegrad_eyeball", "ffr", "kartype", "shipped"])
    wide = registry.registry_wide(one, mode="entry", order=["l_linenumber"], strict=True)
    return registry.typed_registry(wide, {"shipped": "TIMESTAMP"}, keys={"bth_pid": "varchar(255)", "entryid": "varchar(255)"})


@register("unique_ids")
def unique_ids(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the check that their id is a key."""
    return numbering.unique_rows(read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderkey"])


# ------------------------------------------------------------ K6 from stored summaries, id sets
from cathlake.operators import bitmaps, run_summary  # noqa: E402


@register("diagnostic_refresh")
def diagnostic_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Run summaries of the events so far are stored by day; purchases and errors arrive
    later, at any time, and only the days they touch are summarised again."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    late = F.col("event_type").isin("purchase", "error")
    old, new = ev.where(~late | late.isNull()), ev.where(late)
    path = _fresh_path(spark, "summaries/events")
    run_summary.summarise(old, "user_id", "ts", _ev_label()).write.parquet(path)
    cells = run_summary.refresh(spark.read.parquet(path), old, new, "user_id", "ts", _ev_label())
    return run_summary.flag_from(cells, ev, "user_id", "ts")


@register("diagnostic_ids")
def diagnostic_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of all leading runs, as the union of one bitmap set per label."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    runs = episodes.leading_runs(ev, "user_id", "ts", _ev_label())
    sets = [bitmaps.id_set(runs, "event_id", F.col(f"run_{L}")) for L in (1, 0)]
    return bitmaps.members(bitmaps.union(*sets), "event_id")


# ------------------------------------------------------------ D-3, D-4, G3 from stored sketches
from cathlake.operators import sketches  # noqa: E402


@register("cohort_sketch")
def cohort_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct users, distinct (user, day) and users without a purchase by month, from
    sketches stored by day: exact counts, and whether the estimates keep the stated error."""
    ev = read_table(spark, d, "events").select("user_id", "event_type", "ts", F.to_date("ts").alias("day"),
                                               F.trunc("ts", "month").alias("month"))
    buys = F.when(F.col("event_type") == "purchase", F.col("user_id"))
    path = _fresh_path(spark, "sketches/events")
    named = ["users", "user_days", "buyers"]
    sketches.sketch(ev, {"users": F.col("user_id"), "user_days": sketches.value_of("user_id", "day"), "buyers": buys},
                    ["month", "day"]).write.parquet(path)
    got = sketches.merged(spark.read.parquet(path), named, ["month"]).select(
        "month", sketches.estimate("users").alias("e_users"), sketches.estimate("user_days").alias("e_user_days"),
        sketches.without("users", "buyers").alias("e_without"))
    exact = ev.groupBy("month").agg(F.count_distinct("user_id").alias("n_users"),
                                    F.count_distinct(F.struct("user_id", "day")).alias("n_user_days"),
                                    (F.count_distinct("user_id") - F.count_distinct(buys)).alias("n_without"))
    bound = sketches.relative_error()
    near = [F.abs(F.col(f"e_{c}") - F.col(f"n_{c}")) <= F.lit(bound) * F.col(f"n_{of}")
            for c, of in (("users", "users"), ("user_days", "user_days"), ("without", "users"))]
    return exact.join(got, exact["month"].eqNullSafe(got["month"])).select(
        exact["month"], "n_users", "n_user_days", "n_without", (near[0] & near[1] & near[2]).alias("within_error"))


# ------------------------------------------------------------ K4 on arriving rows
from cathlake.functions.ordering import micros  # noqa: E402
from cathlake.streaming import link_stream as streaming_link  # noqa: E402


@register("link_stream")
def link_stream(spark: SparkSession, d: str) -> DataFrame:
    """``link_window`` over files that arrive in two batches, earlier and later half of the
    time, and a heartbeat that closes the last windows."""
    ev = read_table(spark, d, "events").select("event_id", "user_id", "ts", "value", "event_type")
    root = _fresh_path(spark, "link-stream")
    middle = ev.agg(F.percentile_approx(micros(ev, "ts"), 0.5)).first()[0]
    later = F.coalesce(micros(ev, "ts") > middle, F.lit(False))
    end = ev.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    known = {"ts": F.col("ts"), "user_id": F.lit(0)}
    beat = end.select(*[known.get(c, F.lit(None)).cast(ev.schema[c].dataType).alias(c) for c in ev.columns])
    sides = {"images": F.col("event_type") == "error", "procedures": F.col("event_type") == "purchase"}
    schema = ev.drop("event_type").schema
    for i, batch in enumerate((ev.where(~later), ev.where(later), beat)):
        for side, of in sides.items():
            part = batch if batch is beat else batch.where(of)
            part.drop("event_type").write.parquet(f"{root}/{side}/batch{i}")
        streaming_link.start_link_stream(
            spark, f"{root}/images/*", schema, f"{root}/procedures/*", schema, f"{root}/linked", f"{root}/progress",
            lkey="user_id", rkey="user_id", lts="ts", rts="ts", rid="event_id", lid="event_id",
            rcols=["event_id", "ts", "value"]).awaitTermination()
    return spark.read.parquet(f"{root}/linked")


# ------------------------------------------------------------ G3, C9 by bucket digests
from cathlake.operators import digests  # noqa: E402


@register("digest_changes")
def digest_changes(spark: SparkSession, d: str) -> DataFrame:
    """Rows that a new version of orders removed and added, from stored bucket digests: every
    hundredth order has another priority, every 250th is gone."""
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    stored, kept = _stored_orders(spark, od)
    new = od.where(F.col("o_orderkey") % 250 != 0).withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 100 == 0, "0-NEW").otherwise(F.col("o_orderpriority")))
    return digests.changes(stored, new, ["o_orderkey"], kept)


@register("digest_refresh")
def digest_refresh(spark: SparkSession, d: str) -> DataFrame:
    """orders with the priorities of a new version, which holds one changed key in a hundred."""
    od = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    stored, kept = _stored_orders(spark, od)
    new = od.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 100 == 0, "0-NEW").otherwise(F.col("o_orderpriority")))
    return digests.refresh(stored, new, ["o_orderkey"], ["o_orderpriority"], kept)


def _stored_orders(spark: SparkSession, od: DataFrame) -> tuple[DataFrame, DataFrame]:
    """orders as a bucketed table and its stored digests."""
    path = _fresh_path(spark, "digests/orders")
    digests.write_bucketed(od, f"{path}/table", ["o_orderkey"])
    stored = digests.read_bucketed(spark, f"{path}/table")
    digests.digests(stored, ["o_orderkey"]).write.parquet(f"{path}/digests")
    return stored, spark.read.parquet(f"{path}/digests")
