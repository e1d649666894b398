"""Leading-run operators on the label-sequence fixture (F1) and on edge cases,
plus a property check of the aggregate form against a stepwise model."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cathlake.operators import episodes

# Per study, labels in time order and the 1-based positions
# kept for target 0 and target 1 (FIXTURES.md F1). Study 4 has its last two
# rows at the same time.
F1 = [
    ([0, 0, 3, 1, 0], [1, 2], [4]),
    ([1, 0, 1], [2], [1]),
    ([0, 0, 2, 6], [1, 2], []),
    ([0, 0, 1, 0, 0], [1, 2], [3]),
    ([0, 0, 0, 1], [1, 2, 3], [4]),
    ([0, 1, 1, 0, 0], [1], [2, 3]),
    ([1, 1], [], [1, 2]),
    ([1, 0, 0, 1], [2, 3], [1]),
    ([1, 0, 1, 1, 0], [2], [1]),
    ([1, 0, 0, 0, 1], [2, 3, 4], [1]),
    ([1, 1, 0, 0, 1, 1], [3, 4], [1, 2]),
    ([1, 0, 1, 0, 1, 0], [2], [1]),
    ([0, 1, 1], [1], [2, 3]),
]
T0 = dt.datetime(2020, 1, 1, 8, 0, 0)
SCHEMA = "id long, entryid string, labels long, TimeStamp timestamp_ntz"


def f1_rows():
    rows, want0, want1 = [], set(), set()
    rid = 0
    for s, (labels, k0, k1) in enumerate(F1, start=1):
        for pos, lab in enumerate(labels, start=1):
            rid += 1
            ts = T0 + dt.timedelta(days=s, minutes=pos)
            if s == 4 and pos == 5:
                ts = T0 + dt.timedelta(days=s, minutes=4)
            rows.append((rid, f"e{s}", lab, ts))
            if pos in k0:
                want0.add(rid)
            if pos in k1:
                want1.add(rid)
    return rows, want0, want1


def test_f1_golden_positions(spark):
    rows, want0, want1 = f1_rows()
    assert len(rows) == 57 and len(want0) == 21 and len(want1) == 16
    df = spark.createDataFrame(rows, SCHEMA)
    out = episodes.leading_runs(df, "entryid", "TimeStamp", "labels").collect()
    got1 = {r.id for r in out if r.run_1}
    got0 = {r.id for r in out if r.run_0}
    assert got0 == want0
    assert got1 == want1


def test_f1_flag_and_v1_agree_without_nulls(spark):
    rows, want0, want1 = f1_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    flagged = episodes.flag_diagnostic(df, entry="entryid", label="labels")
    assert {r.id for r in flagged.collect() if r.diagnostic_data} == want0 | want1
    for L, want in ((0, want0), (1, want1)):
        v1 = episodes.leading_runs_v1(df, "entryid", "TimeStamp", "labels", L)
        assert {r.id for r in v1.collect()} == want


def t(m):
    return T0 + dt.timedelta(minutes=m)


def test_edge_cases(spark):
    rows = [
        # (a) first 1 tied with a 0 -> nothing kept for 1
        (1, "a", 1, t(1)), (2, "a", 0, t(1)), (3, "a", 1, t(2)),
        # (b) NULL label inside the run -> kept
        (4, "b", 1, t(1)), (5, "b", None, t(2)), (6, "b", 1, t(3)), (7, "b", 0, t(4)),
        # (c) NULL label before the first / after the last 1 -> not kept
        (8, "c", None, t(1)), (9, "c", 1, t(2)), (10, "c", None, t(3)),
        # (d) NULL time sorts last (ranked after every time)
        (11, "d", 1, None), (12, "d", 1, t(1)), (13, "d", 0, t(2)),
        # (e) NULL study never matches
        (14, None, 1, t(1)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.id: r.run_1 for r in episodes.leading_runs(df, "entryid", "TimeStamp", "labels", targets=(1,)).collect()}
    assert {i for i, v in out.items() if v} == {4, 5, 6, 9, 12}
    # K7 keeps the NULL-label rows around the run (c); the NULL time (d) is
    # not before the first 0, so it is not kept.
    v1 = {r.id for r in episodes.leading_runs_v1(df, "entryid", "TimeStamp", "labels", 1).collect()}
    assert {8, 9, 10} <= v1 and 11 not in v1 and 14 not in v1


def test_modality_filter_and_previous_flag(spark):
    rows = [(1, "p", "s", "XA", 1, t(1), False), (2, "p", "s", "OT", 1, t(2), None),
            (3, "p", "s", "XA", 0, t(3), None), (4, None, "s", "XA", 1, t(1), True)]
    df = spark.createDataFrame(rows, "rowid long, PatientID string, StudyInstanceUID string, "
                               "Modality string, labels_predictions long, TimeStamp timestamp_ntz, "
                               "diagnostic_data boolean")
    out = {r.rowid: r.diagnostic_data for r in episodes.flag_diagnostic(df).collect()}
    # 1: first XA 1-run; 3: leading 0-run; 2: other modality keeps NULL;
    # 4: NULL patient keeps its old TRUE.
    assert out == {1: True, 2: None, 3: True, 4: True}


def stepwise(labels_times, L):
    """Independent model: rank, then walk the span."""
    order = sorted(range(len(labels_times)), key=lambda i: (labels_times[i][1] is None, labels_times[i][1] or 0))
    rank = {}
    for pos, i in enumerate(order):
        prev = order[pos - 1] if pos else None
        if prev is not None and labels_times[prev][1] == labels_times[i][1]:
            rank[i] = rank[prev]
        else:
            rank[i] = pos + 1
    lrs = [rank[i] for i, (lab, _) in enumerate(labels_times) if lab == L]
    if not lrs:
        return set()
    lo, hi = min(lrs), max(lrs)
    span = [i for i in range(len(labels_times)) if lo <= rank[i] <= hi]
    bad = [rank[i] for i in span if labels_times[i][0] is not None and labels_times[i][0] != L]
    n = min(bad) if bad else None
    return {i for i in span if n is None or rank[i] < n}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from([0, 1, 2, None]),
                                   st.one_of(st.none(), st.integers(0, 6))),
                         min_size=1, max_size=8), min_size=1, max_size=6))
def test_property_against_stepwise_model(spark, studies):
    rows, want = [], set()
    rid = 0
    for s, seq in enumerate(studies):
        ids = []
        for lab, m in seq:
            rows.append((rid, f"s{s}", lab, None if m is None else t(m)))
            ids.append(rid)
            rid += 1
        lt = [(lab, m) for lab, m in seq]
        for L in (0, 1):
            want |= {ids[i] for i in stepwise(lt, L)}
    df = spark.createDataFrame(rows, SCHEMA)
    out = episodes.leading_runs(df, "entryid", "TimeStamp", "labels")
    got = {r.id for r in out.where(F.col("run_0") | F.col("run_1")).collect()}
    assert got == want


def v1_model(rows, L):
    """Direct model of the stepwise SQL (T1..T7) with SQL NULL rules.
    rows: list of (id, entry, label, t)."""
    def lt(a, b):
        return a is not None and b is not None and a < b

    def smin(vals):
        vals = [v for v in vals if v is not None]
        return min(vals) if vals else None

    t1 = [r for r in rows if r[1] is not None and any(x[1] == r[1] and x[2] == L for x in rows)]
    by = {}
    for r in t1:
        by.setdefault(r[1], []).append(r)
    t2 = {r[0] for r in t1 if lt(r[3], smin(x[3] for x in by[r[1]] if x[2] == L))}
    t3 = [r for r in t1 if r[0] not in t2]
    by3 = {}
    for r in t3:
        by3.setdefault(r[1], []).append(r)

    def not_l(x):
        return x[2] is not None and x[2] != L
    t4 = {r[0] for r in t1 if lt(r[3], smin(x[3] for x in by[r[1]] if not_l(x)))}
    t5 = {r[0] for r in t3 if lt(r[3], smin(x[3] for x in by3[r[1]] if not_l(x)))}
    t6 = {r[0] for r in t1 if len({x[2] for x in by[r[1]] if x[2] is not None}) == 1}
    t7 = {r[0] for r in t3 if len({x[2] for x in by3[r[1]] if x[2] is not None}) == 1}
    return t4 | t5 | t6 | t7


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0, 1, 2, None]),
                          st.one_of(st.none(), st.integers(0, 5))), min_size=1, max_size=14))
def test_v1_against_stepwise_sql_model(spark, seq):
    rows = [(i, e, lab, None if m is None else t(m)) for i, (e, lab, m) in enumerate(seq)]
    df = spark.createDataFrame(rows, SCHEMA)
    for L in (0, 1):
        got = {r.id for r in episodes.leading_runs_v1(df, "entryid", "TimeStamp", "labels", L).collect()}
        assert got == v1_model(rows, L), L
