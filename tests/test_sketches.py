"""Theta sketches: exact while small, within the stated error beyond, merged in any grouping."""

import random

from pyspark.sql import functions as F

from cathlake.operators import sketches


def test_small_sets_are_exact(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(4), rng.choice([None, *range(300)]), rng.choice([None, *range(5)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "part int, a int, b int")
    stored = sketches.sketch(df, {"a": F.col("a"), "ab": sketches.value_of("a", "b"), "some": F.when(F.col("b") == 1, F.col("a"))}, ["part"])
    r = sketches.merged(stored, ["a", "ab", "some"]).select(
        sketches.estimate("a").alias("a"), sketches.estimate("ab").alias("ab"), sketches.without("a", "some").alias("rest")).first()
    values = {a for _, a, _ in rows if a is not None}
    assert r.a == len(values)
    assert r.ab == len({(a, b) for _, a, b in rows})  # NULL parts count
    assert r.rest == len(values - {a for _, a, b in rows if b == 1})


def test_large_sets_keep_the_stated_error(spark):
    df = spark.range(200_000).select("id", (F.col("id") % 7).alias("part"))
    stored = sketches.sketch(df, {"every": F.col("id"), "third": F.when(F.col("id") % 3 == 0, F.col("id"))}, ["part"])
    r = sketches.merged(stored, ["every", "third"]).select(sketches.estimate("every").alias("n"), sketches.without("every", "third").alias("m")).first()
    bound = sketches.relative_error()
    assert 0.04 < bound < 0.05
    assert abs(r.n - 200_000) <= bound * 200_000 and abs(r.m - 133_333) <= bound * 200_000
