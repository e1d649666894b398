"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cathlake.session import checkpoint_dir

ROW = "_cl_row"  # struct holding the caller's columns, so that no name of theirs can clash


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_cathlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="cathlake-pkg-"), "cathlake_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._cathlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table of the data folder, pruned to ``cols`` when given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage on storage every executor can reach, so a lost executor
    costs only its running tasks. The copy carries no partitioning, so a join
    on it gets fresh exchanges that adaptive execution can split on skew.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cathlake-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cl_path = path
    return out


def release(*written: DataFrame) -> None:
    """Delete copies made by ``materialize`` after their last reader has been written."""
    for df in written:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._cl_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, limit: str = "8m") -> Iterator[None]:
    """Jobs run inside send batches of about ``limit`` to Python workers: for rows that are
    large, or workers whose memory goes to vocabularies and caches."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct column, so that helper columns cannot clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def field(name: str) -> Column:
    return F.col(f"{ROW}.`{name}`")


def whole_text(col: Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def row_key(doc_id: Column, text: Column) -> Column:
    """Key (16 bytes) of a document by content: rows with equal doc_id and text
    share it, rows that only repeat a doc_id do not."""
    return F.unhex(F.md5(F.concat_ws("\x01", F.coalesce(doc_id.cast("string"), F.lit("\x02")), text)))


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ``flat[starts[i]:starts[i]+lens[i]]`` for every i of ``idx``;
    also the end offset of each piece."""
    n = lens[idx]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    pos = np.repeat(starts[idx] - (ends - n), n) + np.arange(total)
    return flat[pos], ends


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 by byte planes, as many as the largest needs: they compress well."""
    k = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return bytes([k]) + np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :k].T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    k = raw[0]
    part = np.frombuffer(raw, np.uint8, offset=1).reshape(k, -1)
    out = np.zeros((part.shape[1], 4), np.uint8)
    out[:, :k] = part.T
    return out.view("<u4").reshape(-1)


def file_system(uri: str):
    """The file system of a folder that all executors share, and the path in it."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def schema_plus(df: DataFrame, *added: tuple[str, str]) -> StructType:
    """The schema of ``df`` with (name, type) columns added."""
    return StructType([*df.schema.fields, *StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in added)).fields])
