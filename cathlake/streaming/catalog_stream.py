"""Incremental catalog ingest: new header batches arriving as Parquet files
are merged into the catalog table with the batch upsert.

The table is partitioned by a hash bucket of ``PatientID`` (``_bucket``), so
a micro-batch only rewrites the buckets its patients fall in, whatever it has to
read: a key's base rows lie in the bucket of its own patient. The base is read
with partition pruning, merged with ``upsert_catalog``, cut from its
lineage with ``checkpoint()`` (the write then never reads the files it
replaces) and written back with dynamic partition overwrite. A staging key
with a NULL ``PatientID`` can collide with base rows of any patient under
the ``NOT IN`` rules, so such a batch reads every bucket; the bucket of NULL
patients is always read. New ids continue from the table-wide maximum (a
one-column scan).

Structured Streaming tracks processed files in its checkpoint (under the
shared checkpoint folder) and hands each micro-batch to ``foreachBatch``.
Replaying a batch after a failure is harmless: its keys are already present,
so it rewrites the same paths and adds no ids.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cathlake.operators.upsert import CATALOG_KEY, upsert_catalog

BUCKET = "_bucket"
N_BUCKETS = 256


def bucket_of(col: str = "PatientID", n: int = N_BUCKETS):
    """Hash bucket of the patient id; NULL patients get bucket -1."""
    return F.when(F.col(col).isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int"))


def write_catalog(df: DataFrame, table_path: str, n: int = N_BUCKETS, patient: str = "PatientID") -> None:
    """Write a catalog as a bucket-partitioned Parquet table (initial load)."""
    (df.withColumn(BUCKET, bucket_of(patient, n)).write.mode("errorifexists")
       .partitionBy(BUCKET).parquet(table_path))


def merge_batch(table_path: str, keys: Sequence[str], refresh: Sequence[str],
                order: Sequence[str] | None, id_col: str = "rowid", n: int = N_BUCKETS,
                patient: str = "PatientID"):
    """``foreachBatch`` function merging one micro-batch into the table."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        table = spark.read.parquet(table_path)
        cols = [c for c in table.columns if c != BUCKET]
        stg = batch.select(*cols)
        # touched buckets: at most n + 1 values
        touched = [r[0] for r in stg.select(bucket_of(patient, n)).distinct().collect()]
        if -1 in touched:
            base = table
        else:
            base = table.where(F.col(BUCKET).isin(touched + [-1]))
        start = table.agg((F.coalesce(F.max(id_col), F.lit(-1)) + 1).alias("_cl_start"))
        merged = upsert_catalog(base.select(*cols), stg, keys, refresh, id_col, order,
                                id_start=start)
        merged = merged.withColumn(BUCKET, bucket_of(patient, n)).where(F.col(BUCKET).isin(touched)).checkpoint(eager=True)
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(table_path))
    return fn


def start_catalog_stream(spark: SparkSession, source_dir: str, schema: StructType,
                         table_path: str, checkpoint: str,
                         keys: Sequence[str] = CATALOG_KEY,
                         refresh: Sequence[str] = ("DcmPathFlatten",),
                         order: Sequence[str] | None = None,
                         available_now: bool = True,
                         max_files: int | None = None,
                         n_buckets: int = N_BUCKETS) -> StreamingQuery:
    """Start the stream over a table written with ``write_catalog``. With
    ``available_now`` it processes every file present and stops (a scheduled
    incremental job); otherwise it keeps polling. ``checkpoint`` should sit
    in the shared checkpoint folder."""
    from cathlake.session import checkpoint_dir
    checkpoint_dir(spark)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    src = reader.parquet(source_dir)
    w = (src.writeStream.foreachBatch(merge_batch(table_path, keys, refresh, order, n=n_buckets))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
