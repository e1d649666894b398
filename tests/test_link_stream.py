"""The linkage stream: files in several batches give the batch operator's rows, whatever
their order within the delay; rows beyond the delay are counted, not linked."""

import datetime as dt
import os
import random
import tempfile

from cathlake.operators.linkage import link_window_pairs
from cathlake.streaming.link_stream import late_rows, start_link_stream

SCHEMA = "id long, patient string, ts timestamp, v double"
DAY = dt.datetime(2020, 1, 1)


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def run(spark, root):
    q = start_link_stream(spark, f"{root}/l/*", made(spark, []).schema, f"{root}/r/*", made(spark, []).schema, f"{root}/out",
                          f"{root}/ck", lkey="patient", rkey="patient", lts="ts", rts="ts", rid="id", lid="id", rcols=["id", "ts", "v"])
    assert q.awaitTermination(120)
    return late_rows(q)


def test_link_stream(spark):
    root = tempfile.mkdtemp(prefix="cathlake-link-")
    rng = random.Random(11)

    def some(n, first, low, high):
        return [(first + i, rng.choice(["hot", "hot", "p", "q", None]),
                 rng.choice([None] + [DAY + dt.timedelta(minutes=rng.randrange(low, high))] * 12), float(i)) for i in range(n)]

    batches = [(some(60, 0, 0, 3000), some(50, 0, 0, 3000)), (some(60, 100, 2990, 6000), some(50, 100, 2990, 6000))]
    batches[1][0].append((500, "p", batches[0][1][0][2] or DAY, 0.0))  # an old image: late, or on time if near enough
    end = [(None, "p", DAY + dt.timedelta(days=9), None)]
    late = 0
    for i, (left, right) in enumerate([*batches, (end, end)]):
        made(spark, left).write.parquet(os.path.join(root, "l", f"b{i}"))
        made(spark, right).write.parquet(os.path.join(root, "r", f"b{i}"))
        late += run(spark, root)
    got = spark.read.parquet(f"{root}/out")
    on_time = [r for r in batches[0][0] + batches[1][0] if r[0] != 500]
    want = link_window_pairs(made(spark, on_time), made(spark, batches[0][1] + batches[1][1]), "patient", "patient", "ts", "ts", "id",
                             ["id"], rcols=["id", "ts", "v"])
    assert got.columns == want.columns
    key = lambda r: r[0]
    assert sorted(map(tuple, got.where("id != 500").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert got.where("id = 500").count() == 0 and late >= 1
    assert any(r.pats_id is not None for r in got.collect()) and any(r.pats_id is None for r in got.collect())
