"""Token-id files: exact round trips, damage, and the plain tokenizer over a whole table."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from cathlake.llm import rangecoder, token_files
from edge_docs import SF_SMALL, edge, nothing  # noqa: F401
from tokenizers import Tokenizer


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000, 70_000])
@pytest.mark.parametrize("kind", ["one", "text", "uniform", "runs"])
def test_coder_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"one": np.full(n, 49407), "text": (49408 * rng.random(n) ** 8).astype(int), "uniform": rng.integers(0, 49408, n),
           "runs": np.resize(np.arange(300) * 7, n)}[kind]
    lens, words = rangecoder.encode_ids(ids, 49408)
    assert len(lens) == -(-n // rangecoder.STEPS) and lens.sum() == len(words)
    assert (rangecoder.decode_ids(n, 49408, lens, words) == ids).all()


def test_coder_learns():
    """Ids that orders 0, 1 and 2 predict take fewer bits, in this order."""
    rng = np.random.default_rng(0)
    n, k = 200_000, 64
    skewed = (k * rng.random(n) ** 4).astype(int)
    after1, after2 = rng.integers(0, k, k), rng.integers(0, k, (k, k))
    first, second = skewed.copy(), skewed.copy()
    for i in range(2, n):
        if rng.random() < 0.8:
            first[i] = after1[first[i - 1]]
            second[i] = after2[second[i - 2], second[i - 1]]

    def bits(ids):
        return 16 * len(rangecoder.encode_ids(ids, k)[1]) / n

    counts = np.bincount(skewed) / n
    entropy = -(counts[counts > 0] * np.log2(counts[counts > 0])).sum()
    assert bits(skewed) < entropy + 0.7
    assert bits(first) < 0.6 * bits(skewed) and bits(second) < 0.7 * bits(skewed)


@pytest.mark.parametrize("block", [61, 300, 1000])
def test_blocks_and_documents(block):
    """Documents of any length over blocks of any length come back whole."""
    rng = random.Random(block)
    docs = [(rng.choice([None, -5, i]), np.array([rng.randrange(500) for _ in range(rng.choice([1, 2, 3, 50, 700]))], "<u4"))
            for i in range(40)]
    data = bytearray()
    w = token_files.BlockWriter(data.extend, 500, block)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    assert (w.n_docs, w.n_tokens, w.n_bytes) == (40, sum(len(x) for _, x in docs), len(data))
    assert w.n_blocks == -(-w.n_tokens // block)

    def reader(raw):
        at = [0]

        def read(n):
            at[0] += n
            return bytes(raw[at[0] - n:at[0]])
        return read

    got = [r for rows in token_files.documents(token_files.blocks(reader(data), "x"), True) for r in rows]
    starts = np.cumsum([0] + [len(x) for _, x in docs])
    assert got == [(d, starts[i], len(x), zlib.crc32(x.tobytes()), x.tobytes()) for i, (d, x) in enumerate(docs)]
    for at in (0, 5, 30, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            list(token_files.documents(token_files.blocks(reader(bad), "x"), False))
    with pytest.raises(ValueError):
        list(token_files.documents(token_files.blocks(reader(data[:-1]), "x"), False))


def plain(rows):
    """doc_id, start, n_tokens, CRC and ids in ascending order, by the plain library call."""
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out, at = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


def test_token_files_brute(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    manifest = token_files.write(docs, block=5000)
    got = [tuple(r) for r in token_files.read(manifest, ids=True).collect()]
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted((*r[:4], bytes(r[4])) for r in got) == want
    m = manifest.orderBy("part").collect()
    assert sum(r.n_tokens for r in m) == sum(r[2] for r in want) and len(m) > 1
    assert all(-(-r.n_tokens // 5000) == r.n_blocks for r in m)
    assert sum(r.n_bytes for r in m) < 2 * sum(r[2] for r in want)  # under 16 bits an id


def test_token_files_edge(spark, edge, nothing):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    special = [(20, "a <|endoftext|> b<|startoftext|>C"), (21, "<|ENDOFTEXT|> x.y <|"), (22, "é café"), (23, "  ")]
    docs = edge.unionByName(spark.createDataFrame(special, "doc_id long, text string"), allowMissingColumns=True)
    got = {}
    for r in token_files.read(token_files.write(docs), ids=True).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, bytes(r.ids)))
    want = {}
    for r in plain(rows + special):
        want.setdefault(r[0], []).append((r[1], r[2], r[4]))
    for d in want:  # rows that share a doc_id may take either order
        assert sorted(x[2] for x in got[d]) == sorted(x[2] for x in want[d]), d
    flat = sorted((s, n) for v in got.values() for s, n, _ in v)
    assert [s for s, _ in flat] == np.cumsum([0] + [n for _, n in flat])[:-1].tolist()
    manifest = token_files.write(nothing)
    assert manifest.count() == 0 and token_files.read(manifest).count() == 0


def test_damaged_file_is_told(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    manifest = token_files.write(docs, str(tmp_path))
    victim = sorted(tmp_path.glob("*.cmrc"))[0]
    raw = bytearray(victim.read_bytes())
    raw[-1] ^= 1
    victim.write_bytes(raw)
    with pytest.raises(Exception, match="damaged"):
        token_files.read(manifest).collect()
