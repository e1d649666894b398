"""Sinks: Parquet tables (append, copy into a schema folder, replace via a
staging path), header CSV, and table DDL from a type dictionary.

A table is never overwritten in place while it may be read: replacement
writes a new folder first and swaps it in with the file system's rename.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cathlake.functions.schema import create_table_sql


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "overwrite") -> None:
    """Header CSV in the form that ``readers.read_strings`` reads back cell by cell:
    quotes doubled, line breaks and outer spaces kept."""
    (df.write.mode(mode).option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def append(df: DataFrame, path: str) -> None:
    """Bulk append (the columnar counterpart of a text COPY)."""
    df.write.mode("append").parquet(path)


def create_table(spark: SparkSession, name: str, types: dict, database: str | None = None,
                 location: str | None = None) -> None:
    """Create the catalog table from its type dictionary if it is missing."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    spark.sql(create_table_sql(name, types, location))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def copy_table(df: DataFrame, root: str, schema: str, name: str) -> DataFrame:
    """Copy a table into ``root/schema/name`` (the folder is the schema,
    created when missing) and return the copy as read back."""
    path = f"{root.rstrip('/')}/{schema}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def create_as(df: DataFrame, database: str, name: str, location: str | None = None) -> DataFrame:
    """``CREATE TABLE database.name AS`` the frame (the database is created when
    missing; ``location`` makes the table external) and the table read back."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    w = df.write.mode("errorifexists").format("parquet")
    (w.option("path", location) if location else w).saveAsTable(f"`{database}`.`{name}`")
    return spark.table(f"`{database}`.`{name}`")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path`` with ``df`` (which may read it):
    write a staging folder, rename the old one aside, rename the new one in,
    then delete the old. A rename that fails raises; the old table is put back,
    or, after a crash between the renames, still whole under ``.old-``."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(staging)
    fs, p, jvm = _fs(spark, path)
    new, old = (jvm.org.apache.hadoop.fs.Path(x) for x in (staging, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"))
    had = fs.exists(p)
    if had and not fs.rename(p, old):
        raise OSError(f"cannot move {path} aside; the new table is in {staging}")
    if not fs.rename(new, p):
        if had:
            fs.rename(old, p)
        raise OSError(f"cannot move {staging} to {path}")
    if had:
        fs.delete(old, True)
    return spark.read.parquet(path)


def shared_table_root(spark: SparkSession, sub: str = "cathlake-tables") -> str:
    """A folder under the cluster's shared checkpoint folder for stage and
    copy tables (never a machine-local temp folder)."""
    from cathlake.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{sub}"
