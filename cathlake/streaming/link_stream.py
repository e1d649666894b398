"""Interval linkage of images to procedures on arriving rows (K4 as a stream).

Both sides arrive as files. A stream-stream left outer join pairs every image
with the procedures of its patient within the window, and an aggregate on the
image keeps the nearest one: smallest |dt|, then the earlier procedure, then the
smaller id, as ``linkage.link_window`` does. Both operators run in append mode
under watermarks: an image is written once, when no procedure of its window
can arrive any more, and state older than window + delay is dropped.

The join keys are the patient and a time bucket of the window's width
(procedures are copied to three buckets), so the state of a heavy patient is
spread by time and no pair is met twice.

Defined results: an image without a match keeps NULLs on the right; so does an
image whose patient or time is NULL, written at once. A row that arrives more
than ``delay`` behind its side's latest time may be dropped; ``late_rows``
counts the dropped ones. A row with a NULL id (``lid`` or ``rid``), but a patient
and a time, is a heartbeat: its time moves the watermark and it gives no row.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cathlake.functions.ordering import micros
from cathlake.operators.linkage import _out_names


def _all_set(*names: str):
    """No NULL among the columns. One term that names the time column as well: the optimizer
    moves it not below the watermark, which has to see heartbeats."""
    return F.least(*[F.col(c).isNotNull().cast("int") for c in names]) == 1


def link_arriving(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str, rid: str, lid: str,
                  hours: float = 6.0, delay: str = "1 hour", rcols: Sequence[str] | None = None,
                  prefix: str = "pats_") -> DataFrame:
    """The streaming plan: one row per image of ``left`` with its nearest row of ``right``.

    ``lid`` must be a key of ``left``; columns are named as by ``link_window``.
    """
    width = int(hours * 3600 * 1_000_000)
    reach = F.lit(timedelta(microseconds=width))
    rcols = list(rcols or right.columns)
    names = _out_names(left, rcols, (rkey, rts, rid), prefix)

    images = left.select(F.col(lid).alias("_id"), F.col(lkey).alias("_k"), F.timestamp_micros(micros(left, lts)).alias("_t"),
                         micros(left, lts).alias("_us"), F.struct(*left.columns).alias("_left"))
    a = images.withWatermark("_t", delay).where(_all_set("_t", "_k", "_id")) \
        .withColumn("_b", F.floor(F.col("_us") / width))
    procedures = right.select(F.col(rid).alias("_rid"), F.col(rkey).alias("_rk"), F.timestamp_micros(micros(right, rts)).alias("_rt"),
                              micros(right, rts).alias("_rus"), F.struct(*rcols).alias("_right"))
    b = procedures.withWatermark("_rt", delay) \
        .where(_all_set("_rt", "_rk", "_rid")) \
        .withColumn("_rb", F.explode(F.array(*[F.floor(F.col("_rus") / width) + d for d in (-1, 0, 1)])))
    pairs = a.join(b, (F.col("_k") == F.col("_rk")) & (F.col("_b") == F.col("_rb"))
                   & (F.col("_rt") >= F.col("_t") - reach) & (F.col("_rt") <= F.col("_t") + reach), "leftOuter")
    nearest = F.min(F.struct(F.col("_rt").isNull().alias("none"), F.abs(F.col("_rus") - F.col("_us")).alias("d"),
                             F.col("_rus").alias("rus"), F.col("_rid").alias("rid"), "_right"))
    linked = pairs.groupBy("_t", "_id").agg(nearest.alias("best"), F.first("_left").alias("_left")) \
        .select("_left", F.col("best._right").alias("_right"))
    alone = images.where(F.col("_id").isNotNull() & (F.col("_k").isNull() | F.col("_t").isNull())) \
        .select("_left", F.lit(None).cast(linked.schema["_right"].dataType).alias("_right"))
    return linked.unionByName(alone).select(*[F.col(f"_left.`{c}`") for c in left.columns],
                                            *[F.col(f"_right.`{c}`").alias(names[c]) for c in rcols])


def start_link_stream(spark: SparkSession, left_dir: str, left_schema: StructType, right_dir: str, right_schema: StructType,
                      out_dir: str, checkpoint: str, available_now: bool = True, max_files: int | None = None,
                      **link) -> StreamingQuery:
    """Link the files of both folders into the Parquet table ``out_dir``.

    With ``available_now`` it takes what has arrived and stops; run again with
    the same ``checkpoint`` (in the shared folder) it goes on from there, after a
    failure too: the file sink's log admits each batch once.
    """
    def source(path: str, schema: StructType) -> DataFrame:
        reader = spark.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)

    out = link_arriving(source(left_dir, left_schema), source(right_dir, right_schema), **link)
    writer = out.writeStream.format("parquet").outputMode("append").option("path", out_dir).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that this run's operators dropped as older than their watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
