"""The incremental catalog stream: arriving batches are merged bucket by
bucket, untouched buckets are not rewritten, a replayed batch changes
nothing, and a NULL patient key follows the NOT IN rules across buckets."""

import os
import tempfile

from cathlake.streaming.catalog_stream import start_catalog_stream, write_catalog

CAT = ("rowid long, PatientID string, StudyInstanceUID string, SeriesInstanceUID string, "
       "SOPInstanceUID string, DcmPathFlatten string")


def table_rows(spark, path):
    return sorted((r.rowid, r.PatientID, r.SOPInstanceUID, r.DcmPathFlatten)
                  for r in spark.read.parquet(path).collect())


def test_catalog_stream(spark):
    root = tempfile.mkdtemp(prefix="cathlake-stream-")
    table, src, ck = (os.path.join(root, x) for x in ("table", "src", "ck"))
    base = spark.createDataFrame([(0, "p", "s", "r", "o1", "/a/1"), (5, "q", "s", "r", "o1", "/a/q")], CAT)
    write_catalog(base, table, n=8)
    q_bucket = [d for d in os.listdir(table) if d.startswith("_bucket=")]
    stamp = {d: os.path.getmtime(os.path.join(table, d)) for d in q_bucket}
    b1 = spark.createDataFrame([(None, "p", "s", "r", "o1", "/b/1"), (None, "p", "s", "r", "o2", "/b/2")], CAT)
    b1.write.parquet(os.path.join(src, "batch1"))
    start_catalog_stream(spark, src + "/*", base.schema, table, ck, order=["DcmPathFlatten"],
                         n_buckets=8).awaitTermination(120)
    got = table_rows(spark, table)
    assert got == [(0, "p", "o1", "/b/1"), (5, "q", "o1", "/a/q"), (6, "p", "o2", "/b/2")]
    # the bucket of patient q was not touched (unless p and q share it)
    buckets = {r["PatientID"]: r["_bucket"] for r in spark.read.parquet(table).collect()}
    if buckets["p"] != buckets["q"]:
        d = f"_bucket={buckets['q']}"
        assert os.path.getmtime(os.path.join(table, d)) == stamp[d]
    # the same rows arrive again: nothing changes
    b1.write.parquet(os.path.join(src, "batch2"))
    start_catalog_stream(spark, src + "/*", base.schema, table, ck, order=["DcmPathFlatten"],
                         n_buckets=8).awaitTermination(120)
    assert table_rows(spark, table) == got
    # NULL patient with parts equal to q's row: unknown under NOT IN -> not new
    b3 = spark.createDataFrame([(None, None, "s", "r", "o1", "/c/x"), (None, None, "s", "r", "o7", "/c/y")], CAT)
    b3.write.parquet(os.path.join(src, "batch3"))
    named = [d for d in os.listdir(table) if d.startswith("_bucket=") and d != "_bucket=-1"]
    files = {d: sorted(os.listdir(os.path.join(table, d))) for d in named}
    start_catalog_stream(spark, src + "/*", base.schema, table, ck, order=["DcmPathFlatten"],
                         n_buckets=8).awaitTermination(120)
    assert table_rows(spark, table) == sorted(got + [(7, None, "o7", "/c/y")])
    # the batch read every bucket but wrote only the bucket of NULL patients
    assert files == {d: sorted(os.listdir(os.path.join(table, d))) for d in named}
