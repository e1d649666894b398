"""CSV cells as they were written, missing-value tokens, rejects, counts out of the writing pass."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cathlake.functions import normalize as N
from cathlake.operators.catalog import inventory_rejects, inventory_stages
from cathlake.sources import files, permissive, readers, sinks


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)
    return str(path)


def test_quoted_cells(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'text,n\n"he said ""hi"", ok",1\n"two\nlines, ""x""",2\n" spaced ",3\nback\\slash,4\n')
    for df in (readers.read_strings(spark, p), permissive.read_records(spark, p, ["text", "n"])[0]):
        assert [tuple(r) for r in df.orderBy("n").collect()] == [
            ('he said "hi", ok', "1"), ('two\nlines, "x"', "2"), (" spaced ", "3"), ("back\\slash", "4")]


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_csv_round_trip(spark, tmp_path, sep):
    rng = random.Random(1)
    pool = ['"', "'", ",", "\t", "|", "\n", "\r\n", "\r", " ", "\\", "é", "x", "yz", '""', "\\n", "#", ";"]
    rows = [(str(i), "".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(300)]
    rows = [(i, t) for i, t in rows if t.strip("\r\n")]
    sinks.write_csv(spark.createDataFrame(rows, "id string, text string").repartition(3), str(tmp_path / "t"), sep=sep)
    got = readers.read_strings(spark, str(tmp_path / "t"), sep=sep, missing=None)
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_missing_tokens(spark, tmp_path):
    tokens = ["NA", "NULL", "N/A", "null", "n/a", "NaN", "nan", "#N/A", "None", "<NA>", "-1.#IND", "1.#QNAN", "#NA", "-nan"]
    p = write(tmp_path / "m.csv", "i,x\n" + "".join(f"{i},{t}\n" for i, t in enumerate([*tokens, "", '"NA"', "na", "NAN", "0", "Nullo"])))
    got = [r.x for r in readers.read_strings(spark, p).orderBy(F.col("i").cast("int")).collect()]
    assert got == [None] * (len(tokens) + 2) + ["na", "NAN", "0", "Nullo"]
    assert [r.x for r in readers.read_strings(spark, p, missing=None).where("i = '0'").collect()] == ["NA"]
    cells = spark.createDataFrame([(t,) for t in [*tokens, "NaT", "None00", ""]], "x string")
    assert cells.select(N.null_tokens("x").alias("x")).where("x is not null").count() == 0
    assert cells.where("x = 'NaT'").select(N.null_tokens("x", N.READER_NULLS).alias("x")).first().x == "NaT"


def test_rejected_records(spark, tmp_path):
    p = write(tmp_path / "r.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x\ny",,NA\n')
    rows, rejects = permissive.read_records(spark, p, ["a", "b", "c"])
    assert sorted(map(tuple, rows.collect()), key=repr) == [("1", "2", "3"), ("x\ny", None, None)]
    got = rejects.collect()
    assert sorted(r.record.strip() for r in got) == ["4,5", "6,7,8,9"]
    assert all(r.path.endswith("r.csv") and len(r.cells) == 3 for r in got)


def test_load_counted(spark, tmp_path):
    df = spark.createDataFrame([("1", "1.5", "2020-01-01"), ("x", "NA", "2020-13-01"), ("3.9", "y", "NaT"), (None, "", "zz")],
                               "n string, f string, t string")
    table, counts = permissive.load_counted(df, {"n": "int8", "f": "float8", "t": "TIMESTAMP", "gone": "TEXT"}, str(tmp_path / "t"))
    assert {(r["column"], r["rows"], r["rejected"]) for r in counts.collect()} == {("n", 4, 1), ("f", 4, 1), ("t", 4, 2)}
    assert table.columns == ["n", "f", "t", "gone"] and table.count() == 4
    assert sorted(r.n for r in table.where("n is not null").collect()) == [1, 3]
    empty, none = permissive.load_counted(df.where("false"), {"n": "int8"}, str(tmp_path / "e"))
    assert empty.count() == 0 and [tuple(r) for r in none.collect()] == [("n", 0, 0)]


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    """Each input row is looked at once."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).select(F.col("id").cast("string").alias("n")).mapInPandas(look, "n string")
    permissive.load_counted(df, {"n": "int8"}, str(tmp_path / "t"))
    assert seen.value == 1000


def image_tree(root):
    body = b"\0" * 128 + b"DICM" + b"x" * 20
    for name, data in {"a/1.dcm": body, ".hidden/2.dcm": body, "_x/3.dcm": body, "a/empty": b"", "a/short": b"abc", "a/text": b"y" * 300}.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)


def test_both_inventories_list_every_file(spark, tmp_path):
    image_tree(tmp_path / "images")
    found = []
    for header_only in (True, False):
        valid, counts = inventory_stages(spark, str(tmp_path / "images"), str(tmp_path / f"stage{header_only}"), header_only)
        c = counts.first()
        assert (c.n_candidates, c.n_valid, c.n_unreadable) == (6, 3, 0)
        found.append(sorted(r.path.split("images/")[1] for r in valid.collect()))
        assert inventory_rejects(spark, str(tmp_path / f"stage{header_only}")).count() == 0
    assert found[0] == found[1] == [".hidden/2.dcm", "_x/3.dcm", "a/1.dcm"]


def test_unreadable_files_are_kept(spark, tmp_path):
    """A file that went missing between the stages is told with its reason."""
    image_tree(tmp_path / "images")
    stage = str(tmp_path / "stage")
    files.staged(spark, f"{stage}/candidates", lambda: files.inventory(spark, str(tmp_path / "images")))
    os.remove(tmp_path / "images/a/1.dcm")
    valid, counts = inventory_stages(spark, str(tmp_path / "images"), stage)
    c = counts.first()
    assert (c.n_candidates, c.n_valid, c.n_unreadable) == (6, 2, 1)
    rejected = inventory_rejects(spark, stage).collect()
    assert len(rejected) == 1 and rejected[0].path.endswith("a/1.dcm") and rejected[0].error
