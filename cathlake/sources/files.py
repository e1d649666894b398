"""File inventory of an image tree and the header-validity funnel.

Listing runs in tasks, level by level (``inventory``), and reads no bodies. An image file
carries the 4-byte marker ``DICM`` after a 128-byte preamble; ``header_flags``
reads just those 132 bytes per file in the executors (the header-only read
the original loader does), ``with_header_flag`` is the pure-Spark variant
that reads whole file bodies (fine for small files). Stage lists are stored
as tables so a rerun resumes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Preamble length and the marker that follows it.
PREAMBLE = 128
MAGIC = b"DICM"


def inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Every non-directory file below ``root`` (recursive), hidden and empty
    ones and those in ``_`` folders included; ``pattern`` is a glob on the name.

    Spark's file sources leave those out, so folders are listed in tasks
    through ``pyarrow.fs``, one level of the tree per round: the driver only
    sees how many folders a level has. A folder that cannot be listed raises.
    """
    folders = spark.createDataFrame([(root,)], "path string")
    levels = []
    while True:
        level = _listed(folders).checkpoint()
        levels.append(level.where("not is_dir").select("path", "length", "modificationTime"))
        folders = level.where("is_dir").select("path")
        n = folders.count()
        if not n:
            break
        folders = folders.repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    if pattern:
        regex = re.escape(pattern).replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
        out = out.where(F.col("path").rlike(f"(^|/){regex}$"))
    return out


def _listed(folders: DataFrame) -> DataFrame:
    """The entries of every folder: path, is_dir, length, modificationTime."""

    def entries(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                local = path.startswith("/") or path.startswith("file:")
                if local:  # local paths are listed unencoded
                    fs, p, head = pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
                else:
                    fs, p = pafs.FileSystem.from_uri(path)
                    head = path[:path.index(p)] if p in path else path.split("://")[0] + "://"
                for i in fs.get_file_info(pafs.FileSelector(p)):
                    is_dir = i.type == pafs.FileType.Directory
                    rows.append((head + i.path, is_dir, 0 if is_dir else i.size, i.mtime))
            yield pd.DataFrame(rows, columns=["path", "is_dir", "length", "modificationTime"]).astype(
                {"is_dir": bool, "length": "int64"}) if rows else pd.DataFrame(
                {"path": pd.Series(dtype=str), "is_dir": pd.Series(dtype=bool), "length": pd.Series(dtype="int64"),
                 "modificationTime": pd.Series(dtype="datetime64[ns]")})

    return folders.mapInPandas(entries, "path string, is_dir boolean, length long, modificationTime timestamp")


def with_header_flag(spark: SparkSession, root: str, name: str = "valid") -> DataFrame:
    """Inventory plus a boolean: the marker sits right after the preamble. Bodies are read by
    Spark's own file source, which lists neither hidden nor empty files: these are
    kept from ``inventory``, hidden ones flagged by their header bytes."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    magic = F.lit(bytearray(MAGIC))
    seen = r.select(_plain_path(F.col("path")).alias("_cl_path"),
                    (F.substring(F.col("content"), PREAMBLE + 1, len(MAGIC)) == magic).alias(name))
    every = inventory(spark, root).withColumn("_cl_path", _plain_path(F.col("path")))
    found = every.join(seen, "_cl_path").select("path", "length", "modificationTime", name, F.lit(None).cast("string").alias("error"))
    rest = every.join(seen, "_cl_path", "left_anti").select("path", "length", "modificationTime")
    return found.unionByName(header_flags(rest, name))


def _plain_path(path):
    """A path without what different listings write before a local one."""
    return F.regexp_replace(path, "^file:/*", "/")


def staged(spark: SparkSession, path: str, compute) -> DataFrame:
    """Read the stage table at ``path`` if it is finished (its ``_SUCCESS``
    marker is there), else compute it with ``compute()``, write it and read it
    back. What an interrupted run left at ``path`` is written over."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def header_flags(inventory_df: DataFrame, name: str = "valid") -> DataFrame:
    """Inventory rows plus the header-marker flag, reading only the first
    ``PREAMBLE + 4`` bytes of each file (the bodies are never read).

    Runs as Arrow batches over the inventory's partitions; files are opened
    through ``pyarrow.fs`` (local, HDFS, S3 or GCS URIs). A file that cannot be read
    has a NULL flag and its reason in ``error`` (see ``unreadable``). The task function is self-contained (pickled by value),
    so executors need only pyarrow and pandas, not this package.
    """
    n, start, magic = PREAMBLE + len(MAGIC), PREAMBLE, MAGIC

    def flag(batches):
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd
        import pyarrow.fs as pafs

        def head(path):
            try:
                if path.startswith("file:"):  # Spark lists local paths unencoded
                    p = path[len("file:"):]
                    while p.startswith("//"):
                        p = p[1:]
                    fs = pafs.LocalFileSystem()
                else:
                    fs, p = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(p) as f:
                    return f.read(n), None
            except Exception as e:  # noqa: BLE001  told in the error column
                return None, f"{type(e).__name__}: {e}"[:500]

        # opening files is latency-bound (object stores): a few at a time
        with ThreadPoolExecutor(max_workers=16) as pool:
            for pdf in batches:
                heads = list(pool.map(head, pdf["path"]))
                yield pdf.assign(**{
                    name: pd.Series([None if h is None else len(h) >= n and h[start:n] == magic for h, _ in heads],
                                    dtype=object, index=pdf.index),
                    "error": pd.Series([e for _, e in heads], dtype=object, index=pdf.index)})

    schema = inventory_df.schema.simpleString()[len("struct<"):-1] + f",{name}:boolean,error:string"
    return inventory_df.mapInPandas(flag, schema)


def unreadable(flagged: DataFrame) -> DataFrame:
    """Rejects of ``header_flags``: files that could not be read, with the reason."""
    return flagged.where(F.col("error").isNotNull())
