"""Differences by bucket digests: equal to a comparison of all rows, over the touched
buckets only; digests add up; NULL keys and repeated rows count."""

import collections
import os
import random
import tempfile

from cathlake.operators import digests as D


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_changes_and_add(spark):
    rng = random.Random(3)
    schema = "a int, b string, v double"
    old = [(rng.choice([None, *range(40)]), rng.choice([None, "x", "y"]), rng.choice([None, 1.0, 2.0])) for _ in range(300)]
    new = old[:150] + [old[0]] * 2 + [(k, b, 9.0) for k, b, _ in old[150:160]] + old[160:290]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = {(r.a, r.b, r.v): r.copies if r.change == "added" else -r.copies for r in D.changes(a, b, ["a", "b"], n=16).collect()}
    want = collections.Counter(new)
    want.subtract(collections.Counter(old))
    assert got == {k: n for k, n in want.items() if n}
    assert D.changes(a, b.limit(0).unionByName(a), ["a", "b"], n=16).count() == 0
    first, second = spark.createDataFrame(old[:100], schema), spark.createDataFrame(old[100:], schema)
    summed = D.add(D.digests(first, ["a", "b"], 16), D.digests(second, ["a", "b"], 16))
    assert rows(summed.select(D.BUCKET, *D.SUMS)) == rows(D.digests(a, ["a", "b"], 16))
    nothing = a.limit(0)
    assert D.changes(nothing, nothing, ["a"], n=16).count() == 0
    assert D.changes(nothing, a, ["a"], n=16).where("change = 'removed'").count() == 0


def test_refresh_reads_touched_buckets(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cathlake-digest-"), "t")
    old = spark.range(2000).selectExpr("id AS k", "id * 2 AS v")
    D.write_bucketed(old, path, ["k"], n=64)
    stored = D.read_bucketed(spark, path)
    kept = D.digests(stored, ["k"], 64).checkpoint()
    fresh = old.selectExpr("k", "CASE WHEN k IN (5, 700) THEN -1 ELSE v END AS v")
    touched = D.differing(kept, D.digests(fresh, ["k"], 64))
    assert 1 <= len(touched) <= 2
    out = D.refresh(stored, fresh, ["k"], ["v"], kept, n=64)
    assert rows(out.select("k", "v")) == rows(fresh)
    found = D.changes(stored, fresh, ["k"], kept, n=64)
    assert {(r.k, r.change) for r in found.collect()} == {(5, "removed"), (5, "added"), (700, "removed"), (700, "added")}
    plan = found._jdf.queryExecution().toString()
    assert f"PartitionFilters: [{D.BUCKET}" in plan.replace("#", "") or "PartitionFilters: [" in plan and D.BUCKET in plan
