"""Normalisers (F2 cases), schema conforming, sparse headers (F3), file
inventory and header validity (F10), sinks."""

import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from cathlake.functions import normalize as N, paths as P
from cathlake.functions.ordering import key_for
from cathlake.functions.schema import catalog_types, conform, conform_rejects, create_table_sql, to_struct
from cathlake.operators import cohort
from cathlake.sources import files, headers, readers, sinks


def test_time_and_number_normalisers(spark):
    df = spark.createDataFrame([("9",), ("093015.123",), ("1234567",), ("",), (None,)], "t string")
    got = [(r.a, r.b, r.c) for r in df.select(N.time_text("t").alias("a"), N.time_prefix("t").alias("b"),
                                              N.pad_left("t", 6).alias("c")).collect()]
    assert got == [("900000", "9", "000009"), ("093015.1", "093015", "093015.123"),
                   ("1234567", "123456", "1234567"), ("000000", "000000", "000000"),
                   (None, "000000", None)]
    nums = spark.createDataFrame([("3.0",), ("None",), ("12.7",), ("abc",), ("NaT",)], "s string")
    assert [r.v for r in nums.select(N.to_long("s").alias("v")).collect()] == [3, None, 12, None, None]


def test_combine_ts(spark):
    df = spark.createDataFrame([("20200101", "093015.5"), ("20200101.0", "9"), ("", "120000"),
                                ("00000000", "120000"), ("20200230", "120000"), ("20200101", None)],
                               "d string, t string")
    got = [r.ts for r in df.select(N.combine_ts("d", "t").alias("ts")).collect()]
    assert got == [dt.datetime(2020, 1, 1, 9, 30, 15), dt.datetime(2020, 1, 1, 0, 0, 9), None, None, None,
                   dt.datetime(2020, 1, 1, 0, 0, 0)]


def test_text_functions(spark):
    df = spark.createDataFrame([("a\rb\\c|d\ne",), ("None",), (None,)], "s string")
    out = df.select(N.clean_text("s").alias("c"), N.export_text("s").alias("e")).collect()
    assert out[0].c == "arbc|d\ne" and out[0].e == "a\rb\\c|d\\ne"
    assert out[1].e == "\\N" and out[2].e == "\\N"


def test_paths(spark):
    df = spark.createDataFrame([("/mnt/base/p1/DICOM/x.dcm", "1", "s", "r", "o"),
                                ("/other/x.dcm", "2", None, "r", "o")],
                               "p string, pid string, st string, se string, so string")
    out = df.select(P.relative_to("p", "base").alias("rel"), P.parent_of("p").alias("par"),
                    P.repair_key("pid", "p").alias("fix"),
                    P.hierarchical_path("/d", "pid", "st", "se", "so").alias("h"),
                    P.output_path("/out", "p").alias("o"), P.output_path("/out", F.lit(None).cast("string")).alias("none"),
                    P.flattened_name(F.lit(3), "p").alias("flat")).collect()
    assert out[0].none is None and out[0].flat == "3x.dcm"
    assert out[0].rel == "base/p1/DICOM/x.dcm" and out[1].rel is None
    assert out[0].fix == "p1" and out[1].fix == "2"
    assert out[0].h == "/d/1/s/r/o.dcm" and out[1].h is None
    assert out[0].o == "/out/x.dcm"


def test_schema_conform(spark):
    types = catalog_types()
    assert len(types) == 143 and len(to_struct(types)) == 143
    assert "CREATE TABLE IF NOT EXISTS cat" in create_table_sql("cat", types)
    raw = spark.createDataFrame([("None", "3.0", "a\rb", "9", "True")],
                                "FrameTime string, NumberOfFrames string, Manufacturer string, "
                                "SeriesTime string, diagnostic_data string")
    row = conform(raw, types).collect()[0]
    assert row.FrameTime is None and row.NumberOfFrames == 3 and row.Manufacturer == "arb"
    assert row.SeriesTime == "900000" and row.diagnostic_data is True and row.rowid is None


def test_sparse_headers(spark):
    df = spark.createDataFrame([(1, '{"PatientID": "p", "NumberOfFrames": "12"}'),
                                (2, '{"PatientID": "q", "Extra": "x"}'), (3, "not json {")],
                               "id long, raw string")
    parsed = headers.parse_json_records(df, "raw")
    ok, bad = headers.split_rejects(parsed)
    out = headers.project_map(ok, "header", {"PatientID": "varchar(255)", "NumberOfFrames": "int8"},
                              keep=["id"]).orderBy("id").collect()
    assert [(r.id, r.PatientID, r.NumberOfFrames) for r in out] == [(1, "p", 12), (2, "q", None)]
    assert [r.id for r in bad.collect()] == [3]


def test_inventory_and_funnel(spark):
    root = tempfile.mkdtemp(prefix="cathlake-tree-")
    flat, nested = os.path.join(root, "flat"), os.path.join(root, "nested", "a", "b")
    os.makedirs(flat), os.makedirs(nested), os.makedirs(os.path.join(root, "flat", "sub"))
    for d in (flat, nested):
        open(os.path.join(d, "img1.dcm"), "wb").write(b"\0" * 128 + b"DICM" + b"rest")
        open(os.path.join(d, "img2.dcm"), "wb").write(b"\0" * 128 + b"DICM")
        open(os.path.join(d, "note.txt"), "w").write("not an image")
        open(os.path.join(d, "empty"), "wb").close()
    a = files.inventory(spark, flat).count()
    b = files.inventory(spark, os.path.join(root, "nested")).count()
    assert a == b == 4  # the empty file too
    flagged = files.with_header_flag(spark, root)
    fun = cohort.funnel(flagged, {"candidates": F.lit(True), "valid": F.col("valid")}).collect()[0]
    assert (fun.candidates, fun.valid) == (8, 4)  # empty files are candidates in both variants
    # header-only read gives the same flags
    head = files.header_flags(files.inventory(spark, root))
    assert sorted((r.path, r.valid) for r in head.collect()) == \
        sorted((r.path, r.valid) for r in flagged.collect())
    assert files.unreadable(head).count() == 0
    stage = os.path.join(root, "stage_valid")
    first = files.staged(spark, stage, lambda: flagged.where("valid").select("path"))
    again = files.staged(spark, stage, lambda: flagged.select("path"))  # not recomputed
    assert first.count() == again.count() == 4
    os.remove(os.path.join(stage, "_SUCCESS"))  # an interrupted run has no marker
    assert files.staged(spark, stage, lambda: flagged.select("path")).count() == 8


def test_inventory_lists_every_file(spark):
    root = tempfile.mkdtemp(prefix="cathlake-five-")
    os.makedirs(os.path.join(root, "_sub", "deep"))
    names = ["a.dcm", ".hidden", "_under", "empty", "_sub/deep/b.dcm"]
    for n in names:
        with open(os.path.join(root, n), "wb") as f:
            f.write(b"" if n == "empty" else b"x")
    got = {r.path for r in files.inventory(spark, root).collect()}
    assert got == {"file:" + os.path.join(root, n) for n in names}
    assert files.inventory(spark, root, "*.dcm").count() == 2
    gone = files.inventory(spark, root)
    gone = spark.createDataFrame(gone.collect(), gone.schema)
    os.remove(os.path.join(root, "a.dcm"))
    lost = files.unreadable(files.header_flags(gone)).collect()
    assert [os.path.basename(r.path) for r in lost] == ["a.dcm"] and lost[0].valid is None and lost[0].error


def test_order_key_refuses_other_types(spark):
    df = spark.createDataFrame([(1.2,)], "x double")
    with pytest.raises(TypeError):
        key_for(df, "x")


def test_sinks_and_readers(spark):
    root = tempfile.mkdtemp(prefix="cathlake-sink-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    copied = sinks.copy_table(df, root, "cag", "t")
    assert copied.count() == 2
    replaced = sinks.replace_table(copied.where("k = 1"), os.path.join(root, "cag", "t"))
    assert replaced.count() == 1
    sinks.write_csv(df, os.path.join(root, "csv"))
    back = readers.read_strings(spark, os.path.join(root, "csv"))
    assert dict(back.dtypes) == {"k": "string", "v": "string"}
    ids = readers.read_id_list(spark, os.path.join(root, "csv"), "k")
    assert sorted(r.k for r in ids.collect()) == ["1", "2"]
    # headerless one-column path list (A4) and bulk append (A11)
    paths = spark.createDataFrame([("/a/1.dcm",), ("/a/2.dcm",)], "path string")
    sinks.write_csv(paths, os.path.join(root, "list"), header=False)
    back = readers.read_path_list(spark, os.path.join(root, "list"))
    assert sorted(r.path for r in back.collect()) == ["/a/1.dcm", "/a/2.dcm"]
    sinks.append(df, os.path.join(root, "appended"))
    sinks.append(df, os.path.join(root, "appended"))
    assert spark.read.parquet(os.path.join(root, "appended")).count() == 4


def test_header_flags_odd_names(spark):
    root = tempfile.mkdtemp(prefix="cathlake-names-")
    os.makedirs(os.path.join(root, "sub dir"))
    open(os.path.join(root, "sub dir", "a b#1%.dcm"), "wb").write(b"\0" * 128 + b"DICM")
    open(os.path.join(root, "short.dcm"), "wb").write(b"DICM")
    got = {os.path.basename(r.path): r.valid for r in files.header_flags(files.inventory(spark, root)).collect()}
    assert got == {"a b#1%.dcm": True, "short.dcm": False}


def test_create_table_from_dictionary(spark):
    loc = tempfile.mkdtemp(prefix="cathlake-ddl-")
    sinks.create_table(spark, "cl_test_catalog", catalog_types(), location=loc)
    t = spark.table("cl_test_catalog")
    assert t.columns == list(catalog_types()) and t.count() == 0
    assert dict(t.dtypes)["TimeStamp"] == "timestamp_ntz" and dict(t.dtypes)["confidences"] == "array<string>"
    spark.sql("DROP TABLE cl_test_catalog")


def test_conform_rejects(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "None"), (None, "y")], "a string, b string")
    got = {r.column: r.rejected for r in conform_rejects(df, {"a": "int8", "b": "varchar(9)", "c": "float8"}).collect()}
    assert got == {"a": 1, "b": 0}


def test_create_as_and_empty_warning(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    made = sinks.create_as(spark.range(3), "cl_test_db", name, tempfile.mkdtemp(prefix="cathlake-ctas-") + "/t")
    assert made.count() == 3 and spark.table(f"cl_test_db.{name}").count() == 3
    with pytest.warns(UserWarning, match="no rows"):
        readers.sql_source(spark, "SELECT * FROM none_left", {"none_left": spark.range(0)}, warn_empty=True)
