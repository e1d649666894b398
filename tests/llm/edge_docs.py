import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"

CLASH = ["key", "hash", "pos", "comp", "node", "length", "offset", "sequence_id", "bucket", "a", "b", "n", "ids", "kept",
         "spans", "_cl_row", "_cl_key", "_cl_text"]


LETTERS = str.maketrans("0123456789", "ghijklmnop")


def prose(rng, n, vocabulary=400):
    return " ".join(f"word{rng.randrange(vocabulary):x}".translate(LETTERS) for _ in range(n))


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with nulls, empty and long texts, repeated rows, one doc_id twice, and clashing column names."""
    rng = random.Random(5)
    long = "\n".join(prose(rng, 300, 5000) for _ in range(60))
    a, b = prose(rng, 120), prose(rng, 90)
    near = a.split()
    near[60] = "other"
    rows = [(1, None, "s1"), (2, "", "s1"), (3, " \n\t ", None), (4, long, "s2"), (5, a, "s3"), (6, a, "s4"),
            (7, " ".join(near), "s5"), (8, b, "s6"), (8, b, "s6"), (8, b + " tail", "s6"), (None, prose(rng, 80), "s7"),
            (9, "mail x.y@mail.example.com now " + prose(rng, 60), "s8"), (10, "one two", "s9")]
    rows = [(*r, *[f"{c}-{i}" for c in CLASH]) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASH))


@pytest.fixture(scope="session")
def nothing(spark, edge):
    return spark.createDataFrame([], edge.schema)
