"""Ranks under heavy ties, run summaries, id sets, key checks: against plain Python forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cathlake.operators import bitmaps, episodes, numbering, registry, run_summary, ties


def ranks(rows, method):
    """{id: rank} of (id, group, value) with NULL values last."""
    out = {}
    for i, g, v in rows:
        mine = [(x is None, x) for _, h, x in rows if h == g]
        less = [x for x in mine if (x[0], x[1] if x[1] is not None else 0) < (v is None, v if v is not None else 0)]
        out[i] = 1 + (len(less) if method == "rank" else len(set(less)))
    return out


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
@pytest.mark.parametrize("parts", [1, 2, 7])
def test_tie_rank(spark, method, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, None, 1, 1, 1, *range(12)])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    got = {r.id: r.n for r in ties.tie_rank(df, ["g"], ["v"], "n", method, parts=parts).collect()}
    assert got == ranks(rows, method)
    by_group = {r.id: r.n for r in numbering.group_rank(df, ["g"], ["v"], "n", method, parts=parts).collect()}
    assert by_group == got


def test_tie_rank_group_over_partitions(spark):
    """One group of many values spans all partitions, next to small ones."""
    rows = [(i, 1, i // 3) for i in range(600)] + [(1000 + i, 2 + i % 5, i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g int, v int")
    got = {r.id: r.n for r in ties.tie_rank(df, ["g"], ["v"], "n", parts=9).collect()}
    assert got == ranks(rows, "rank")


def test_tie_rank_holds_no_tie(spark):
    """The range sort moves one row per distinct (group, value), however many rows tie."""
    df = spark.range(20_000).select("id", F.lit("g").alias("g"), F.when(F.col("id") >= 15_000, F.col("id") % 50).alias("v"))
    seen = []
    whole = numbering.sorted_checkpoint

    def watched(pairs, *a, **k):
        seen.append(pairs.count())
        return whole(pairs, *a, **k)

    ties.sorted_checkpoint, out = watched, None
    try:
        out = ties.tie_rank(df, ["g"], ["v"])
    finally:
        ties.sorted_checkpoint = whole
    assert seen == [51]
    got = {r.v: (r.lo, r.hi, r.n) for r in out.groupBy("v").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.count("*").alias("n")).collect()}
    assert got[None] == (5001, 5001, 15_000) and got[0] == (1, 1, 100) and got[49] == (4901, 4901, 100)


def test_tie_rank_empty_and_unknown(spark):
    df = spark.createDataFrame([], "id long, g string, v int")
    assert ties.tie_rank(df, ["g"], ["v"]).count() == 0
    with pytest.raises(ValueError):
        ties.tie_rank(df, ["g"], ["v"], method="row_number")


T0 = dt.datetime(2024, 1, 1)


def image_rows(seed, n=400):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 1, 2, 3, None]), T0 + dt.timedelta(hours=rng.randrange(24 * 20)) if rng.random() < 0.95 else None,
             rng.choice([0, 1, 1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_refreshed_summaries_flag_as_a_full_run(spark, seed):
    rows = image_rows(seed)
    schema = "id long, study int, t timestamp_ntz, label int"
    df = spark.createDataFrame(rows, schema)
    want = {r.id: (r.run_1 or r.run_0) for r in episodes.leading_runs(df, "study", "t", "label").collect()}
    rng = random.Random(seed)
    part = {r[0]: rng.randrange(3) for r in rows}
    pieces = [spark.createDataFrame([r for r in rows if part[r[0]] == k], schema) for k in range(3)]
    cells, old = run_summary.summarise(pieces[0], "study", "t", "label"), pieces[0]
    for new in pieces[1:]:
        cells = run_summary.refresh(cells, old, new, "study", "t", "label").checkpoint()
        old = old.unionByName(new)
    got = {r.id: bool(r.diagnostic_data) for r in run_summary.flag_from(cells, df, "study", "t").collect()}
    assert got == want
    # Coarser cells hold the same: the summaries of neighbours merge.
    wide = run_summary.merge(cells, grain=run_summary.DAY, coarse=5)
    direct = run_summary.summarise(df, "study", "t", "label", grain=5 * run_summary.DAY)
    assert sorted(map(repr, wide.select(direct.columns).collect())) == sorted(map(repr, direct.collect()))


def test_refresh_reads_touched_cells_only(spark):
    """What is stored for other cells is taken as it is."""
    schema = "id long, study int, t timestamp_ntz, label int"
    old = spark.createDataFrame([(1, 1, T0, 1), (2, 1, T0 + dt.timedelta(days=3), 1), (3, 2, T0, 1)], schema)
    new = spark.createDataFrame([(4, 1, T0 + dt.timedelta(hours=2), 0)], schema)
    stored = run_summary.summarise(old, "study", "t", "label")
    marked = stored.withColumn("hi_1", F.when(F.col("_cl_entry") == 2, F.lit(-7)).otherwise(F.col("hi_1")))
    got = run_summary.refresh(marked, old, new, "study", "t", "label").collect()
    assert [r.hi_1 for r in got if r._cl_entry == 2] == [-7]
    assert sum(r._cl_entry == 1 for r in got) == 2
    cell = min((r for r in got if r._cl_entry == 1), key=lambda r: r._cl_cell)
    assert cell.fa_1 is not None and cell.fa_0 is None


def test_bitmaps(spark):
    rng = random.Random(4)
    a = {rng.randrange(200_000) for _ in range(500)} | {0, 1, 32_767, 32_768, 65_535, 65_536}
    b = {rng.randrange(200_000) for _ in range(500)} | {5_000_000_000}
    frames = [spark.createDataFrame([(x, True) for x in sorted(s) for _ in range(2)] + [(None, True), (-3, True), (77, False)],
                                    "id long, ok boolean") for s in (a, b)]
    sets = [bitmaps.id_set(f, "id", F.col("ok")) for f in frames]
    for s, want in zip(sets, (a, b), strict=True):
        assert sorted(r.id for r in bitmaps.members(s).collect()) == sorted(want)
    both = bitmaps.union(*sets)
    assert sorted(r.id for r in bitmaps.members(both).collect()) == sorted(a | b)
    assert bitmaps.size(both).first().n == len(a | b)
    none = bitmaps.id_set(frames[0].where("false"), "id")
    assert bitmaps.members(none).count() == 0 and bitmaps.size(none).first().n == 0


def test_unique_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 3), (None, "c", 4)], "id int, x string, y int")
    assert sorted(map(repr, numbering.unique_rows(df, ["id"]).collect())) == sorted(map(repr, df.collect()))
    twice = df.unionByName(spark.createDataFrame([(2, "z", 9)], df.schema))
    for use in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("x").collect(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="repeated key"):
            use(numbering.unique_rows(twice, ["id"]))

    def shuffles(d):
        return d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(numbering.unique_rows(df, ["id"])) == shuffles(numbering.keep_first(df, ["id"], ["x"])) == 1


def registry_rows(spark, more=()):
    cols = ["bth_pid", "entryid", "procedurestart_lokalbed_velse", "sub_entryid", "proceduresite", "stenosegrad_eyeball", "ffr",
            "kartype", "bmi", "kommentar", "n"]
    rows = [("p1", "1", "2020-01-01 10:00:00", "s1", "5 LM", "50", "0.8", "x", "27.5", "NA", 1),
            ("p1", "1", "2020-01-01 10:00:00", "s1", "9 D1", "70.5", None, "y", "27.5", "text", 2),
            ("p1", "1", "2020-01-01 10:00:00", "s2", "5 LM", "20", "bad", "z", "28", "text", 3),
            ("p0", "2", "2019-01-01 09:00:00", "s1", None, None, None, None, "heavy", "null", 4), *more]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'n' else 'string'}" for c in cols))


@pytest.mark.parametrize("mode", ["entry", "sub_entry"])
def test_strict_pivot(spark, mode):
    df = registry_rows(spark)
    loose, strict = (registry.registry_wide(df, mode=mode, order=["n"], strict=s) for s in (False, True))
    assert loose.columns == strict.columns
    assert sorted(map(repr, loose.collect())) == sorted(map(repr, strict.collect()))
    planted = registry_rows(spark, [("p1", "1", "2020-01-01 10:00:00", "s2", "5 LM", "20", "bad", "z", "28", "text", 5)])
    assert registry.registry_wide(planted, mode=mode, order=["n"]).count() == loose.count()
    with pytest.raises(Exception, match="several rows for .*5 LM"):
        registry.registry_wide(planted, mode=mode, order=["n"], strict=True).collect()

    def shuffles(d):
        return d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(loose) == shuffles(strict)


def test_typed_registry(spark):
    wide = registry.registry_wide(registry_rows(spark), order=["n"])
    got = registry.typed_registry(wide, {"bmi": "float8", "kommentar": "TEXT"})
    types = registry.registry_types(["bmi", "kommentar"], {"bmi": "float8", "kommentar": "TEXT"})
    assert list(types)[:6] == ["rowid", "bth_pid", "entryid", "timestamp", "bmi", "kommentar"] and len(types) == 6 + 48
    assert got.columns == list(types)
    kinds = dict(got.dtypes)
    assert (kinds["rowid"], kinds["entryid"], kinds["timestamp"], kinds["bmi"], kinds["Sten %: 9 D1"], kinds["kartype: 5 LM"]) == (
        "bigint", "bigint", "timestamp_ntz", "double", "double", "string")
    rows = {r.bth_pid: r for r in got.collect()}
    assert (rows["p0"].rowid, rows["p1"].rowid, rows["p0"].bmi, rows["p0"].kommentar) == (0, 1, None, None)
    assert (rows["p1"].entryid, rows["p1"].bmi, rows["p1"]["Sten %: 9 D1"], rows["p1"]["ffr %: 5 LM"]) == (1, 27.5, 70.5, 0.8)
