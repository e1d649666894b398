"""NULL semantics of NOT IN / IN, tuple NOT IN against a brute-force truth
table, and the catalog upsert (F8)."""

import itertools

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cathlake.operators import numbering, setjoin, upsert


def test_not_in_single_column(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert sorted(r.k for r in setjoin.not_in(left, spark.createDataFrame([(1,)], "k long"), "k").collect()) == [2]
    # A NULL on the right empties the result.
    r_null = spark.createDataFrame([(1,), (None,)], "k long")
    assert setjoin.not_in(left, r_null, "k").count() == 0
    # Against an empty right side every row is kept, NULL included.
    empty = spark.createDataFrame([], "k long")
    assert setjoin.not_in(left, empty, "k").count() == 3


def sql_not_in(l, rs):
    """Brute force: SQL row-value NOT IN with three-valued logic."""
    for r in rs:
        # the row comparison is TRUE when some pair is non-NULL and unequal
        if any(a is not None and b is not None and a != b for a, b in zip(l, r)):
            continue
        return False  # equal (FALSE) or unknown (NULL) -> not kept
    return True


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(*[st.sampled_from([1, 2, None])] * 3), max_size=8),
       st.lists(st.tuples(*[st.sampled_from([1, 2, None])] * 3), max_size=8))
def test_not_in_tuple_matches_truth_table(spark, left, right):
    schema = "a long, b long, c long"
    lid = [(i,) + t for i, t in enumerate(left)]
    ldf = spark.createDataFrame(lid, "id long, " + schema)
    rdf = spark.createDataFrame(right, schema)
    got = sorted(r.id for r in setjoin.not_in_tuple(ldf, rdf, ["a", "b", "c"]).collect())
    want = sorted(i for i, *t in lid if sql_not_in(t, right))
    assert got == want


def test_tuple_not_in_plan_has_no_nested_loop(spark):
    l = spark.createDataFrame([(1, 2, None, 4)], "a long, b long, c long, d long")
    r = spark.createDataFrame([(1, None, 3, 4), (5, 6, 7, 8)], "a long, b long, c long, d long")
    out = setjoin.not_in_tuple(l, r, ["a", "b", "c", "d"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan
    assert out.count() == 0  # (1,2,NULL,4) vs (1,NULL,3,4): all shared pairs equal -> unknown


def test_semi_in_and_unions(spark):
    l = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    r = spark.createDataFrame([(1,), (None,)], "j long")
    assert [x.k for x in setjoin.semi_in(l, r, ["k"], ["j"]).collect()] == [1]
    a = spark.createDataFrame([(1, "x")], "k long, s string")
    b = spark.createDataFrame([(2,)], "k long")
    u = setjoin.union_all(a, b).collect()
    assert sorted((x.k, x.s) for x in u) == [(1, "x"), (2, None)]
    assert setjoin.union_distinct(a.select("k"), a.select("k"), b).count() == 2


CAT = ("rowid long, PatientID string, StudyInstanceUID string, SeriesInstanceUID string, "
       "SOPInstanceUID string, DcmPathFlatten string")


def test_upsert_catalog(spark):
    base = spark.createDataFrame([
        (0, "p1", "s1", "r1", "o1", "/old/1"),
        (5, "p1", "s1", "r1", "o2", "/old/2"),      # ids with gaps
        (7, "p2", None, "r1", "o1", "/old/3"),      # key with a NULL part
    ], CAT)
    stg = spark.createDataFrame([
        (None, "p1", "s1", "r1", "o2", "/new/2"),   # existing key, new path
        (None, "p3", "s1", "r1", "o1", "/new/4"),   # new key
        (None, "p3", "s1", "r1", "o1", "/new/4b"),  # duplicate staging key
        (None, "p2", None, "r1", "o1", "/new/3"),   # NULL part: not new, not refreshed
        (None, "p4", "s9", "r1", "o1", "/new/5"),   # new key
    ], CAT)
    out = upsert.upsert_catalog(base, stg, order=["DcmPathFlatten"]).collect()
    got = sorted((r.rowid, r.PatientID, r.DcmPathFlatten) for r in out)
    assert got == [(0, "p1", "/old/1"), (5, "p1", "/new/2"), (7, "p2", "/old/3"),
                   (8, "p3", "/new/4"), (9, "p4", "/new/5")]


def test_dense_ids_and_group_rank(spark):
    rows = [(g, v, i) for i, (g, v) in enumerate(itertools.product(["a", "b", None], [3, 1, 1, None]))]
    df = spark.createDataFrame(rows, "g string, v long, id long")
    ids = numbering.dense_ids(df, ["id"], "rid", start=10, parts=3).collect()
    assert sorted(r.rid for r in ids) == list(range(10, 10 + len(rows)))
    assert all(r.rid == r.id + 10 for r in ids)
    rk = {r.id: r.rank for r in numbering.group_rank(df, ["g"], ["v"], parts=4).collect()}
    dr = {r.id: r.dr for r in numbering.group_rank(df, ["g"], ["v"], "dr", "dense_rank", parts=4).collect()}
    rn = {r.id: r.rn for r in numbering.group_rank(df, ["g"], ["v"], "rn", "row_number",
                                                   tiebreak=["id"], parts=4).collect()}
    # per group values in insertion order 3, 1, 1, NULL -> ranks 3, 1, 1, 4 (NULLs last)
    for base_id in (0, 4, 8):
        assert [rk[base_id + k] for k in range(4)] == [3, 1, 1, 4]
        assert [dr[base_id + k] for k in range(4)] == [2, 1, 1, 3]
        assert [rn[base_id + k] for k in range(4)] == [3, 1, 2, 4]


def test_keep_first_and_pick_min(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0)],
                               "k long, p string, x long")
    got = sorted(tuple(r) for r in numbering.keep_first(df, ["k"], ["p"]).collect())
    assert got == [(1, "a", 9), (2, None, 1)]  # NULLs first
    # DISTINCT ON k ORDER BY x: payload of the row with the smallest x
    picked = sorted(tuple(r) for r in numbering.pick_min(df, ["k"], [F.col("x")], ["p"]).collect())
    assert picked == [(1, "b"), (2, "z")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 4))),
                min_size=1, max_size=30), st.integers(1, 6))
def test_group_rank_against_model(spark, rows, parts):
    data = [(i, g, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g string, v long")

    def key(v):  # NULLs last
        return (v is None, v if v is not None else 0)
    want_rank, want_dense, want_rn = {}, {}, {}
    for g in {g for _, g, _ in data}:
        members = sorted([(key(v), i) for i, gg, v in data if gg == g])
        vals = sorted({k for k, _ in members})
        for pos, (k, i) in enumerate(members):
            want_rn[i] = pos + 1
            want_rank[i] = 1 + sum(1 for kk, _ in members if kk < k)
            want_dense[i] = vals.index(k) + 1
    rk = {r.id: r.rank for r in numbering.group_rank(df, ["g"], ["v"], parts=parts).collect()}
    dr = {r.id: r.d for r in numbering.group_rank(df, ["g"], ["v"], "d", "dense_rank", parts=parts).collect()}
    rn = {r.id: r.n for r in numbering.group_rank(df, ["g"], ["v"], "n", "row_number",
                                                  tiebreak=["id"], parts=parts).collect()}
    assert rk == want_rank and dr == want_dense and rn == want_rn


def test_global_rank_without_groups(spark):
    df = spark.createDataFrame([(1, 5), (2, 3), (3, 5), (4, None)], "id long, v long")
    got = {r.id: r.rank for r in numbering.group_rank(df, [], ["v"], parts=2).collect()}
    assert got == {2: 1, 1: 2, 3: 2, 4: 4}
    dr = {r.id: r.d for r in numbering.group_rank(df, [], ["v"], "d", "dense_rank").collect()}
    assert dr == {2: 1, 1: 2, 3: 2, 4: 3}


def test_upsert_with_empty_sides(spark):
    base = spark.createDataFrame([(3, "p", "s", "r", "o", "/a")], CAT)
    empty = spark.createDataFrame([], CAT)
    same = upsert.upsert_catalog(base, empty, order=["DcmPathFlatten"]).collect()
    assert [(r.rowid, r.DcmPathFlatten) for r in same] == [(3, "/a")]
    fresh = upsert.upsert_catalog(empty, base, order=["DcmPathFlatten"]).collect()
    assert [(r.rowid, r.DcmPathFlatten) for r in fresh] == [(0, "/a")]


def test_upsert_with_non_unique_base(spark):
    base = spark.createDataFrame([(0, "p", "s", "r", "o", "/a"), (1, "p", "s", "r", "o", "/a2"),
                                  (2, "q", "s", "r", "o", "/b")], CAT)
    stg = spark.createDataFrame([(None, "p", "s", "r", "o", "/new"), (None, "z", "s", "r", "o", "/z")], CAT)
    salted = sorted(tuple(r) for r in upsert.upsert_catalog(base, stg, order=["DcmPathFlatten"],
                                                            base_unique=False).collect())
    plain = sorted(tuple(r) for r in upsert.upsert_catalog(base, stg, order=["DcmPathFlatten"]).collect())
    assert salted == plain
    assert [r[5] for r in salted] == ["/new", "/new", "/b", "/z"]
