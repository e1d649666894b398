"""Independent DuckDB SQL for each registered plan (tables pre-registered as
views). Written from the operator semantics with plain joins, correlated
subqueries and window functions, not from the Spark plans."""

from __future__ import annotations

from cathlake.operators.registry import SITES

ORACLE: dict[str, str] = {}

_LI_BASE = """
  SELECT l_orderkey AS entry, l_shipdate AS ts,
         CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 WHEN 'A' THEN 2 END AS label
  FROM lineitem WHERE l_linestatus = 'F'"""

_EV_BASE = """
  SELECT user_id AS entry, ts,
         CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 ELSE 2 END AS label
  FROM events"""


def _runs_kept(base: str) -> str:
    """(entry, ts, L) of rows in the leading run of L, stepwise: rank, first
    and last L rank, first foreign rank inside the span."""
    return f"""
ranked AS (SELECT entry, ts, label,
                  rank() OVER (PARTITION BY entry ORDER BY ts ASC NULLS LAST) AS r
           FROM ({base}) b WHERE entry IS NOT NULL),
tgt AS (SELECT * FROM (VALUES (0), (1)) v(L)),
span AS (SELECT r.entry, t.L, min(r.r) AS lo, max(r.r) AS hi
         FROM ranked r JOIN tgt t ON r.label = t.L GROUP BY r.entry, t.L),
stop AS (SELECT s.entry, s.L, min(r.r) AS n
         FROM span s JOIN ranked r ON r.entry = s.entry AND r.r BETWEEN s.lo AND s.hi
                                   AND r.label <> s.L
         GROUP BY s.entry, s.L),
kept AS (SELECT DISTINCT r.entry, r.ts, s.L
         FROM ranked r JOIN span s ON r.entry = s.entry AND r.r BETWEEN s.lo AND s.hi
         LEFT JOIN stop p ON p.entry = s.entry AND p.L = s.L
         WHERE p.n IS NULL OR r.r < p.n)"""


ORACLE["diagnostic_flag"] = f"""
WITH {_runs_kept(_LI_BASE)}
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate,
       l.l_returnflag, l.l_linestatus,
       CASE WHEN l.l_linestatus = 'F' AND EXISTS (
              SELECT 1 FROM kept k WHERE k.entry = l.l_orderkey
                AND k.ts IS NOT DISTINCT FROM l.l_shipdate) THEN TRUE END AS diagnostic_data
FROM lineitem l
"""

ORACLE["diagnostic_flag_events"] = f"""
WITH {_runs_kept(_EV_BASE)}
SELECT e.event_id, e.user_id, e.ts, e.event_type,
       CASE WHEN EXISTS (SELECT 1 FROM kept k WHERE k.entry = e.user_id
                           AND k.ts IS NOT DISTINCT FROM e.ts) THEN TRUE END AS diagnostic_data
FROM events e
"""

ORACLE["leading_runs"] = f"""
WITH {_runs_kept(_EV_BASE)}
SELECT e.event_id, e.user_id, e.ts, e.event_type,
       EXISTS (SELECT 1 FROM kept k WHERE k.entry = e.user_id AND k.L = 1
                 AND k.ts IS NOT DISTINCT FROM e.ts) AS run_1,
       EXISTS (SELECT 1 FROM kept k WHERE k.entry = e.user_id AND k.L = 0
                 AND k.ts IS NOT DISTINCT FROM e.ts) AS run_0
FROM events e
"""


def _v1(L: int) -> str:
    return f"""
SELECT * FROM (
WITH c AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS label
           FROM conversations),
t1 AS (SELECT * FROM c WHERE conv_id IN (SELECT DISTINCT conv_id FROM c WHERE label = {L})),
t2 AS (SELECT * FROM t1 a WHERE a.turn < (SELECT min(b.turn) FROM t1 b
                                          WHERE b.conv_id = a.conv_id AND b.label = {L})),
t3 AS (SELECT * FROM t1 WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM t2)),
t4 AS (SELECT * FROM t1 a WHERE a.turn < (SELECT min(b.turn) FROM t1 b
                                          WHERE b.conv_id = a.conv_id AND b.label <> {L})),
t5 AS (SELECT * FROM t3 a WHERE a.turn < (SELECT min(b.turn) FROM t3 b
                                          WHERE b.conv_id = a.conv_id AND b.label <> {L})),
t6 AS (SELECT * FROM t1 WHERE conv_id IN (
         SELECT conv_id FROM t1 GROUP BY conv_id HAVING count(DISTINCT label) = 1)),
t7 AS (SELECT * FROM t3 WHERE conv_id IN (
         SELECT conv_id FROM t3 GROUP BY conv_id HAVING count(DISTINCT label) = 1))
SELECT * FROM t4 UNION SELECT * FROM t5 UNION SELECT * FROM t6 UNION SELECT * FROM t7)
"""


ORACLE["runs_v1"] = f"""
SELECT conv_id, turn, role, label, 1 AS target FROM ({_v1(1)})
UNION ALL
SELECT conv_id, turn, role, label, 0 AS target FROM ({_v1(0)})
"""

ORACLE["group_extremum"] = """
WITH ext AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events
             WHERE event_type = 'click' GROUP BY user_id)
SELECT e.event_id, e.user_id, e.ts, e.event_type, e.ts = x.lo AS at_first, e.ts = x.hi AS at_last
FROM events e JOIN ext x ON e.user_id = x.user_id
WHERE e.ts = x.lo OR e.ts = x.hi
"""

ORACLE["corr_min"] = """
SELECT a.event_id, a.user_id, a.ts, a.event_type FROM events a
WHERE a.ts < (SELECT min(b.ts) FROM events b
              WHERE b.user_id = a.user_id AND b.event_type = 'purchase')
"""

ORACLE["uniform_groups"] = """
SELECT user_id, CAST(ts AS DATE) AS day, min(event_type) AS label, count(*) AS n_rows
FROM events GROUP BY user_id, CAST(ts AS DATE)
HAVING count(DISTINCT event_type) = 1
"""

ORACLE["distinct_entry"] = "SELECT DISTINCT user_id, event_type FROM events"

ORACLE["series_expand"] = """
SELECT p_partkey, p_size, n
FROM part, LATERAL (SELECT unnest(generate_series(1, p_size - 40)) AS n)
"""

_LI_ALL = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
           "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

ORACLE["rank_ts"] = """
SELECT event_id, user_id, CAST(ts AS DATE) AS day,
       CAST(rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS BIGINT) AS rank
FROM events
"""

ORACLE["dense_rank_day"] = """
SELECT event_id, user_id, CAST(ts AS DATE) AS day,
       CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS BIGINT) AS drank
FROM events
"""

ORACLE["row_number_ts"] = """
SELECT event_id, user_id, ts,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rn
FROM events
"""

ORACLE["serial_ids"] = f"""
SELECT {_LI_ALL},
       CAST(row_number() OVER (ORDER BY {_LI_ALL.replace(',', ' NULLS FIRST,')} NULLS FIRST) - 1 AS BIGINT) AS rowid
FROM lineitem
"""

ORACLE["dedup_key"] = f"""
SELECT {_LI_ALL} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
           l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
           l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1
"""

ORACLE["batch_assign"] = """
WITH n AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part),
     c AS (SELECT ceil(count(*) / 8.0) AS size FROM part)
SELECT p_partkey, p_name, CAST(idx AS BIGINT) AS idx, CAST(floor(idx / size) AS BIGINT) AS batch
FROM n, c
"""

ORACLE["dup_groups"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

_CUST = """(SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey END AS ckey
            FROM customer)"""

ORACLE["anti_not_in"] = f"""
SELECT c_custkey, c_name, ckey FROM {_CUST} c
WHERE ckey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
"""

ORACLE["anti_not_in_null"] = f"""
SELECT c_custkey, c_name, ckey FROM {_CUST} c
WHERE ckey NOT IN (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END FROM orders)
"""

# Row-value NOT IN spelled out with SQL's pairwise rule: a left row is kept
# unless some right row agrees with it on every pair where both are
# non-NULL. k1 and k4 are never NULL in this data, so they are plain
# equalities (which also lets DuckDB hash the join).
ORACLE["anti_tuple"] = """
WITH l AS (SELECT l_orderkey AS k1, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS k2,
                  l_suppkey AS k3, l_linenumber AS k4, l_shipdate FROM lineitem),
     r AS (SELECT l_orderkey AS k1, l_partkey AS k2,
                  CASE WHEN l_tax = 0 THEN NULL ELSE l_suppkey END AS k3, l_linenumber AS k4
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01')
SELECT * FROM l WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.k1 = l.k1 AND r.k4 = l.k4
    AND (r.k2 = l.k2 OR r.k2 IS NULL OR l.k2 IS NULL)
    AND (r.k3 = l.k3 OR r.k3 IS NULL OR l.k3 IS NULL))
"""

ORACLE["semi_in"] = """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""

ORACLE["union_distinct"] = """
SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click'
UNION SELECT user_id, CAST(ts AS DATE) FROM events WHERE event_type IS DISTINCT FROM 'click'
"""

ORACLE["union_all"] = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
"""

_ORD = """SELECT o_orderkey * 2 AS rowid, o_custkey, o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority, o_orderdate, '/{tag}/' || CAST(o_orderkey AS VARCHAR) AS path
FROM orders WHERE {cond}"""

ORACLE["catalog_upsert"] = f"""
WITH base AS ({_ORD.format(tag='a', cond="o_orderdate < TIMESTAMP '1997-01-01'")}),
     stg0 AS ({_ORD.format(tag='b', cond="o_orderdate >= TIMESTAMP '1996-01-01'")}),
     stg AS (SELECT * FROM stg0 QUALIFY row_number() OVER (
               PARTITION BY o_custkey, o_orderkey, o_orderstatus, o_orderpriority
               ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST, rowid, path) = 1),
     fresh AS (SELECT * FROM stg s WHERE NOT EXISTS (
               SELECT 1 FROM base b WHERE
                 (b.o_custkey = s.o_custkey OR b.o_custkey IS NULL OR s.o_custkey IS NULL)
             AND (b.o_orderkey = s.o_orderkey OR b.o_orderkey IS NULL OR s.o_orderkey IS NULL)
             AND (b.o_orderstatus = s.o_orderstatus OR b.o_orderstatus IS NULL OR s.o_orderstatus IS NULL)
             AND (b.o_orderpriority = s.o_orderpriority OR b.o_orderpriority IS NULL OR s.o_orderpriority IS NULL))),
     mx AS (SELECT coalesce(max(rowid), -1) AS m FROM base)
SELECT b.rowid, b.o_custkey, b.o_orderkey, b.o_orderstatus, b.o_orderpriority, b.o_orderdate,
       coalesce(s.path, b.path) AS path
FROM base b LEFT JOIN stg s
  ON b.o_custkey = s.o_custkey AND b.o_orderkey = s.o_orderkey
 AND b.o_orderstatus = s.o_orderstatus AND b.o_orderpriority = s.o_orderpriority
UNION ALL
SELECT CAST(mx.m + row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS BIGINT),
       o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, path
FROM fresh, mx
"""

ORACLE["link_window"] = """
WITH l AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error'),
     r AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT l.event_id, l.user_id, l.ts, l.value,
       r.event_id AS pats_event_id, r.ts AS pats_ts, r.value AS pats_value
FROM l LEFT JOIN r ON l.user_id = r.user_id
  AND r.ts BETWEEN l.ts - INTERVAL 6 HOURS AND l.ts + INTERVAL 6 HOURS
QUALIFY row_number() OVER (PARTITION BY l.event_id
  ORDER BY abs(epoch_us(r.ts) - epoch_us(l.ts)) NULLS LAST, r.ts, r.event_id) = 1
"""

ORACLE["link_window_dup"] = """
WITH l AS (SELECT event_id % 997 AS image, user_id, ts, event_id FROM events WHERE event_type IS DISTINCT FROM 'purchase'),
     r AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT l.image, l.user_id, l.ts, l.event_id,
       r.event_id AS pats_event_id, r.ts AS pats_ts, r.value
FROM l LEFT JOIN r ON l.user_id = r.user_id
  AND r.ts BETWEEN l.ts - INTERVAL 6 HOURS AND l.ts + INTERVAL 6 HOURS
QUALIFY row_number() OVER (PARTITION BY l.image
  ORDER BY abs(epoch_us(r.ts) - epoch_us(l.ts)) NULLS LAST, r.ts, r.event_id, l.ts, l.user_id, l.event_id) = 1
"""


def _wide(measures, sites, reducer="min"):
    return ",\n  ".join(f"{reducer}(CASE WHEN l_linenumber = {s} THEN {m} END) AS {p}{s}"
                        for m, p in measures for s in sites)


ORACLE["registry_wide"] = f"""
SELECT l_orderkey,
  arg_min(l_shipdate, (l_linenumber, l_partkey, l_suppkey)) AS l_shipdate,
  arg_min(l_linestatus, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS l_linestatus,
  {_wide([("l_quantity", "qty_"), ("l_discount", "disc_"), ("l_returnflag", "flag_")], range(1, 8))}
FROM lineitem GROUP BY l_orderkey
"""

ORACLE["synth_labels"] = """
WITH v AS (SELECT event_id, user_id,
  [('0x' || substr(md5('7:' || i || ':' || event_id), 1, 7))::BIGINT FOR i IN [0, 1, 1000]] AS n FROM events)
SELECT event_id, user_id, CASE WHEN event_id IN (1, 2) THEN 1 ELSE n[1] % 3 END AS labels_transformed, n[2] % 3 AS labels,
       n[3] / 268435456.0::DOUBLE AS sten_proc_1_prox_rca_transformed
FROM v
"""

ORACLE["registry_first"] = """
WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity) = 1)
SELECT l_orderkey, """ + ", ".join(
    f"max(CASE WHEN l_linenumber = {s} THEN l_quantity END) AS qty_{s}" for s in range(1, 8)) + """
FROM f GROUP BY l_orderkey
"""

ORACLE["pivot_conflicts"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

_PROFILE_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]
ORACLE["cardinality_profile"] = "WITH g AS (SELECT l_orderkey, " + ", ".join(
    f"count(DISTINCT {c}) AS {c}" for c in _PROFILE_COLS) + " FROM lineitem GROUP BY l_orderkey)\n" + \
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_counts, "
        f"count(DISTINCT {c}) <> 1 AS multi_entry FROM g" for c in _PROFILE_COLS)

_ORD_CAT = """(SELECT o_orderstatus AS Modality, CAST(o_custkey AS VARCHAR) AS PatientID,
       CASE WHEN starts_with(o_orderpriority, '5') THEN NULL ELSE o_orderpriority END AS StudyInstanceUID,
       CASE WHEN o_totalprice > 400000 THEN NULL ELSE '/f/' || CAST(o_orderkey AS VARCHAR) END AS DcmPathFlatten
FROM orders)"""

ORACLE["cohort_counts"] = f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE Modality = 'F') AS n_f,
       count(*) FILTER (WHERE Modality = 'O') AS n_o,
       count(*) FILTER (WHERE Modality = 'P') AS n_p,
       count(DcmPathFlatten) AS n_paths,
       count(DISTINCT PatientID) AS n_patients,
       count(DISTINCT (PatientID, StudyInstanceUID)) AS n_studies,
       count(DISTINCT DcmPathFlatten) AS n_loops,
       count(DISTINCT PatientID) FILTER (WHERE Modality = 'F') AS n_patients_f,
       count(DISTINCT (PatientID, StudyInstanceUID)) FILTER (WHERE Modality = 'F') AS n_studies_f
FROM {_ORD_CAT}
"""

ORACLE["funnel"] = """
SELECT count(*) AS n_candidates,
       count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NOT NULL) AS n_valid,
       count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NOT NULL
                          AND event_type <> 'error') AS n_transformable
FROM events
"""

ORACLE["cohort_phase"] = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
            THEN 'test' ELSE 'train' END AS phase
FROM orders
"""

ORACLE["label_merge"] = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id IS NOT DISTINCT FROM l.doc_id
"""

_TIME_RAW = """CASE event_type
    WHEN 'view' THEN CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS VARCHAR)
    WHEN 'purchase' THEN ''
    WHEN 'click' THEN strftime(ts, '%H%M%S') || '.123'
    WHEN 'signup' THEN CAST(hour(ts) AS VARCHAR)
    ELSE strftime(ts, '%H%M%S') END"""

ORACLE["time_norm"] = f"""
SELECT event_id, t_raw,
       substr(rpad(t_raw, CAST(greatest(6, length(t_raw)) AS INTEGER), '0'), 1, 8) AS t_text,
       substr(coalesce(nullif(t_raw, ''), '000000'), 1, 6) AS t_prefix,
       lpad(t_raw, CAST(greatest(6, length(t_raw)) AS INTEGER), '0') AS t_pad
FROM (SELECT event_id, {_TIME_RAW} AS t_raw FROM events)
"""

_NULLTOK = "CASE WHEN {c} IN ('None', 'NaT', 'None00', 'nan', '') THEN NULL ELSE {c} END"

ORACLE["num_norm"] = f"""
SELECT event_id, s,
       CAST(trunc(TRY_CAST({_NULLTOK.format(c='s')} AS DOUBLE)) AS BIGINT) AS as_long,
       TRY_CAST({_NULLTOK.format(c='s')} AS DOUBLE) AS as_double
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'None' WHEN 'view' THEN ''
        WHEN 'signup' THEN 'NaT'
        WHEN 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.7'
        ELSE 'x' || CAST(event_id AS VARCHAR) END AS s FROM events)
"""


def _digits(c: str, n: int) -> str:
    v = f"CAST(coalesce(CAST(trunc(TRY_CAST({_NULLTOK.format(c=c)} AS DOUBLE)) AS BIGINT), 0) AS VARCHAR)"
    return f"lpad({v}, CAST(greatest({n}, length({v})) AS INTEGER), '0')"


_DATE_RAW = """CASE WHEN event_type = 'error' THEN ''
    WHEN event_type = 'signup' THEN strftime(ts, '%Y%m%d') || '.0'
    WHEN event_type = 'view' AND value > 45 THEN '20240230'
    ELSE strftime(ts, '%Y%m%d') END"""
_SERIES_TIME = """CASE event_type
    WHEN 'view' THEN CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS VARCHAR)
    WHEN 'purchase' THEN 'None'
    WHEN 'click' THEN strftime(ts, '%H%M%S') || '.5'
    ELSE strftime(ts, '%H%M%S') END"""

ORACLE["ts_combine"] = f"""
SELECT event_id, date_s, time_s,
       try_strptime({_digits('date_s', 8)} || {_digits('time_s', 6)}, '%Y%m%d%H%M%S') AS "TimeStamp"
FROM (SELECT event_id, {_DATE_RAW} AS date_s, {_SERIES_TIME} AS time_s FROM events)
"""

ORACLE["text_clean"] = r"""
SELECT doc_id, replace(replace(text, chr(13), 'r'), '\', '') AS text_clean FROM documents
"""

ORACLE["text_export"] = r"""
SELECT doc_id,
       coalesce(replace(CASE WHEN text IN ('None', 'NaT') THEN NULL ELSE text END, chr(10), '\n'), '\N')
         AS text_export
FROM documents
"""

ORACLE["path_build"] = """
WITH o AS (SELECT o_orderkey, '/data/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR)
                  || '/' || CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END
                  || '/' || o_orderpriority || '.dcm' AS path FROM orders)
SELECT o_orderkey, path, '/out/' || regexp_extract(path, '[^/]*$') AS out_path,
       CAST(o_orderkey AS VARCHAR) || regexp_extract(path, '[^/]*$') AS flat_name
FROM o
"""

ORACLE["path_relative"] = """
SELECT page_id, url, substr(url, strpos(url, 'example')) AS rel FROM pages
WHERE strpos(url, 'example') > 0
"""

ORACLE["path_patient"] = """
WITH c AS (SELECT c_custkey,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD'
         THEN '/data/' || c_name || '/DICOM/' || CAST(c_custkey AS VARCHAR) || '.dcm'
         ELSE '/data/' || c_name || '/' || CAST(c_custkey AS VARCHAR) || '.dcm' END AS path,
    CAST(c_custkey AS VARCHAR) AS pid FROM customer)
SELECT c_custkey, path,
       CASE WHEN contains(path, '/DICOM') THEN regexp_extract(split_part(path, '/DICOM', 1), '[^/]*$')
            ELSE pid END AS "PatientID"
FROM c
"""

ORACLE["scan_project"] = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS c_phone, CAST(NULL AS BOOLEAN) AS c_active,
       CAST(NULL AS TIMESTAMP) AS c_since
FROM customer
"""

ORACLE["sql_source"] = """
SELECT r.r_name, n.n_name, count(c.c_custkey) AS n_customers
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY r.r_name, n.n_name
"""

ORACLE["ctas_copy"] = "SELECT * FROM part"

ORACLE["sparse_header"] = """
SELECT event_id, CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT) AS k,
       CAST(NULL AS VARCHAR) AS source
FROM events
"""

ORACLE["sort_limit"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
"""

ORACLE["catalog_build"] = f"""
WITH rec AS (
  SELECT '/archive/base/' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) || '.dcm' AS path,
         CAST(user_id AS VARCHAR) AS "PatientID", strftime(ts, '%Y%m%d') AS "StudyInstanceUID",
         event_type AS "SeriesInstanceUID", json_extract_string(props, '$.k') AS "SOPInstanceUID",
         CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y%m%d') END AS sd,
         strftime(ts, '%H%M%S') || '.5' AS st,
         CASE WHEN event_type = 'error' THEN 'OT' ELSE 'XA' END AS "Modality",
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0' AS "NumberOfFrames"
  FROM events),
p AS (SELECT *, substr(path, strpos(path, 'base')) AS "DcmPathFlatten",
             {_NULLTOK.format(c='sd')} AS sdn, {_NULLTOK.format(c='st')} AS stn
      FROM rec WHERE strpos(path, 'base') > 0),
q AS (SELECT *, try_strptime({_digits('sdn', 8)} || {_digits('stn', 6)}, '%Y%m%d%H%M%S') AS "TimeStamp",
             coalesce(sdn, '0') AS "DateStamp",
             substr(coalesce(nullif(stn, ''), '000000'), 1, 6) AS st6
      FROM p),
f AS (SELECT * FROM q QUALIFY row_number() OVER (
        PARTITION BY "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID"
        ORDER BY "DcmPathFlatten" NULLS FIRST) = 1)
SELECT CAST(row_number() OVER (ORDER BY "DcmPathFlatten") - 1 AS BIGINT) AS rowid,
       "DcmPathFlatten", sdn AS "StudyDate", "TimeStamp", "DateStamp",
       substr(rpad(st6, CAST(greatest(6, length(st6)) AS INTEGER), '0'), 1, 8) AS "SeriesTime",
       "Modality", "PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID",
       CAST(trunc(TRY_CAST("NumberOfFrames" AS DOUBLE)) AS BIGINT) AS "NumberOfFrames"
FROM f
"""

_MEAS = [("stenosegrad_eyeball", "Sten %: "), ("ffr", "ffr %: "), ("kartype", "kartype: ")]

_LI_REG = """
SELECT CAST(l_orderkey AS VARCHAR) AS bth_pid,
       CAST(l_orderkey AS VARCHAR) || '-' || l_linestatus AS entryid,
       CASE WHEN l_tax = 0 THEN NULL ELSE '2000-01-01 00:00:00' END AS procedurestart_lokalbed_velse,
       CAST(l_suppkey AS VARCHAR) AS sub_entryid,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE (%s)[l_linenumber] END AS proceduresite,
       CAST(l_quantity AS VARCHAR) AS stenosegrad_eyeball, CAST(l_discount AS VARCHAR) AS ffr,
       l_returnflag AS kartype, CASE WHEN l_discount > 0.07 THEN NULL ELSE strftime(l_shipdate, '%%Y-%%m-%%d') END AS shipped, l_linenumber
FROM lineitem""" % ("[" + ", ".join(f"'{v}'" for v in SITES) + "]")


def _level1() -> str:
    cols = ",\n  ".join(f"min(CASE WHEN proceduresite = '{v}' THEN {m} END) AS \"{p}{v}\""
                        for m, p in _MEAS for v in SITES)
    return f"""SELECT bth_pid, entryid, procedurestart_lokalbed_velse, sub_entryid,
  {cols}
FROM ({_LI_REG}) WHERE procedurestart_lokalbed_velse IS NOT NULL
GROUP BY bth_pid, entryid, procedurestart_lokalbed_velse, sub_entryid"""


def _q(m):
    return ", ".join(f'"{p}{v}"' for mm, p in _MEAS if mm == m for v in SITES)


def _qd(m):
    return ", ".join(f'TRY_CAST("{p}{v}" AS DOUBLE) AS "{p}{v}"' for mm, p in _MEAS if mm == m for v in SITES)


_FIRST_ROW = f"""(SELECT bth_pid AS b, entryid AS e, procedurestart_lokalbed_velse AS p, shipped FROM ({_LI_REG})
  WHERE procedurestart_lokalbed_velse IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY bth_pid, entryid, procedurestart_lokalbed_velse
                             ORDER BY l_linenumber, shipped NULLS FIRST) = 1)"""

ORACLE["registry_entry"] = f"""
WITH l1 AS ({_level1()})
SELECT bth_pid, entryid, CAST(procedurestart_lokalbed_velse AS TIMESTAMP) AS "timestamp", shipped,
       {_qd('stenosegrad_eyeball')}, {_qd('ffr')}, {_q('kartype')}
FROM l1 JOIN {_FIRST_ROW} a ON bth_pid = b AND entryid = e AND procedurestart_lokalbed_velse = p
QUALIFY row_number() OVER (PARTITION BY bth_pid, entryid, procedurestart_lokalbed_velse
                                   ORDER BY sub_entryid) = 1
"""

ORACLE["registry_sub_entry"] = f"""
WITH l1 AS ({_level1()}),
     f AS (SELECT * FROM l1 QUALIFY row_number() OVER (
             PARTITION BY bth_pid, entryid, procedurestart_lokalbed_velse ORDER BY sub_entryid) = 1)
SELECT s.bth_pid, s.entryid, CAST(s.procedurestart_lokalbed_velse AS TIMESTAMP) AS "timestamp",
       s.sub_entryid, a.shipped,
       {", ".join(f'TRY_CAST(f."{p}{v}" AS DOUBLE) AS "{p}{v}"' for m, p in _MEAS[:2] for v in SITES)},
       {", ".join(f's."{p}{v}"' for v in SITES for p in ["kartype: "])}
FROM l1 s JOIN f ON s.bth_pid = f.bth_pid AND s.entryid = f.entryid
  AND s.procedurestart_lokalbed_velse = f.procedurestart_lokalbed_velse
JOIN {_FIRST_ROW} a ON s.bth_pid = b AND s.entryid = e AND s.procedurestart_lokalbed_velse = p
"""

ORACLE["tsv_ingest"] = """
SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part
"""

ORACLE["exclusion_report"] = f"""
SELECT count(*) AS n_excluded, count(DISTINCT PatientID) AS n_patients_excluded
FROM {_ORD_CAT} c
WHERE DcmPathFlatten NOT IN (SELECT '/f/' || CAST(o_orderkey AS VARCHAR) FROM orders
                             WHERE o_totalprice <= 300000)
"""

ORACLE["rank_ties"] = """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) END AS day FROM events)
SELECT event_id, event_type, day,
       CAST(rank() OVER (PARTITION BY event_type ORDER BY day ASC NULLS LAST) AS BIGINT) AS rank,
       CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY day ASC NULLS LAST) AS BIGINT) AS drank
FROM e
"""

ORACLE["csv_ingest"] = r"""
SELECT doc_id, replace(replace(' "' || text || '", ' || chr(10) || lang || ' ', chr(13), 'r'), '\', '') AS text,
       CASE WHEN lang IN ('fr', 'de', 'es') THEN NULL ELSE source END AS source,
       CASE WHEN lang = 'fr' THEN NULL ELSE CAST(n_chars AS BIGINT) END AS n_chars
FROM documents
"""

ORACLE["reject_counts"] = """
SELECT 'NumberOfFrames' AS "column", count(*) AS "rows",
       count(*) FILTER (event_type NOT IN ('error', 'view', 'signup', 'click')) AS rejected FROM events
UNION ALL SELECT 'FrameTime', count(*), count(*) FILTER (event_type = 'click') FROM events
UNION ALL SELECT 'TimeStamp', count(*), count(*) FILTER (event_type = 'signup') FROM events
UNION ALL SELECT 'PatientID', count(*), 0 FROM events
"""

_LI_ONE = f"""SELECT * FROM ({_LI_REG}) QUALIFY row_number() OVER (
  PARTITION BY bth_pid, entryid, procedurestart_lokalbed_velse, sub_entryid, proceduresite
  ORDER BY l_linenumber, stenosegrad_eyeball NULLS FIRST, ffr NULLS FIRST, kartype NULLS FIRST, shipped NULLS FIRST) = 1"""

ORACLE["registry_typed"] = f"""
WITH w AS ({ORACLE['registry_entry'].replace(_LI_REG, _LI_ONE)})
SELECT CAST(row_number() OVER (ORDER BY bth_pid, entryid, "timestamp") - 1 AS BIGINT) AS rowid,
       bth_pid, entryid, "timestamp", CAST(shipped AS TIMESTAMP) AS shipped,
       {", ".join(f'"{p}{v}"' for _, p in _MEAS for v in SITES)}
FROM w
"""

ORACLE["unique_ids"] = "SELECT o_orderkey, o_custkey, o_orderdate FROM orders"

ORACLE["diagnostic_refresh"] = ORACLE["diagnostic_flag_events"]

ORACLE["diagnostic_ids"] = f"""
SELECT DISTINCT event_id FROM ({ORACLE['diagnostic_flag_events']}) f WHERE diagnostic_data
"""

ORACLE["cohort_sketch"] = """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS n_users,
       count(DISTINCT (user_id, CAST(ts AS DATE))) AS n_user_days,
       count(DISTINCT user_id) - count(DISTINCT user_id) FILTER (event_type = 'purchase') AS n_without, TRUE AS within_error
FROM events GROUP BY ALL
"""

ORACLE["link_stream"] = ORACLE["link_window"]

ORACLE["digest_changes"] = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders)
SELECT o_orderkey, o_custkey, o_orderpriority, 'removed' AS change, CAST(count(*) AS BIGINT) AS copies
FROM o WHERE o_orderkey % 250 = 0 OR o_orderkey % 100 = 0 AND o_orderpriority IS DISTINCT FROM '0-NEW' GROUP BY ALL
UNION ALL
SELECT o_orderkey, o_custkey, '0-NEW', 'added', CAST(count(*) AS BIGINT)
FROM o WHERE o_orderkey % 250 <> 0 AND o_orderkey % 100 = 0 AND o_orderpriority IS DISTINCT FROM '0-NEW' GROUP BY ALL
"""

ORACLE["digest_refresh"] = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 100 = 0 THEN '0-NEW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""
