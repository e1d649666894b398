"""Cross-tokenizer alignment against a token-by-token form with whole-text library calls."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from cathlake.llm import align
from edge_docs import SF_SMALL, edge, nothing  # noqa: F401
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

ODD = ["a", " ", "  ", "   ", "\n", "\t", "\r\n", "é", "é", "ß", "你好", "😀", "\U0010ffff", "\x00", "\x7f", "word", "Word", "the",
       " the", "don't", "12", "3.14", ",", ".", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", " ", "　", "ﬁ", "▁", "\x01"]


def odd_texts(n, seed=0, without=""):
    rng = random.Random(seed)
    pool = [x for x in ODD if x not in without]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    alphabet = {}
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    for b in shown:
        alphabet[chr(b)] = b
    for i, b in enumerate(b for b in range(256) if b not in shown):
        alphabet[chr(256 + i)] = b

    def tokens(text):
        """(id, bytes) of both sides, or nothing where bytes differ."""
        if not text:
            return [], []
        a = [(i, bytes(alphabet[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
             for i in sp.encode(text)]
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    return tokens


def brute(texts, tokens):
    """Rows by text index, from all overlapping pairs of byte ranges."""
    rows, links, count = [], [], collections.Counter()
    for text in texts:
        sides = []
        for side in tokens(text):
            at, out = 0, []
            for i, raw in side:
                out.append((i, at, at + len(raw)))
                at += len(raw)
            sides.append(out)
        a, b = sides
        mine = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(mine)
        links.append(mine)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([i for i, _, e in a if s < e <= t], [i for i, _, e in b if s < e <= t]) for s, t in zip([0, *ends], ends, strict=False)]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(mine), hashlib.sha256(text.encode()).hexdigest() if groups else "", groups))
    highest = collections.defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return [(*r[:4], sum(count[p] == highest[p[1]] for p in mine), sum(count[p] for p in mine), r[4], r[5])
            for r, mine in zip(rows, links, strict=True)], count


def as_rows(df):
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect()]


def test_pieces_by_segments():
    sp = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = odd_texts(4000) + ["", " ", "  ", " a", "a ", "a  ", "  a  b   c ", "\n", " \n "]
    got = align.encode_pieces(pa.array(texts), P.path("piece_bpe_32k.model"))
    for t, g in zip(texts, got, strict=True):
        assert g.tolist() == sp.encode(t), repr(t)


def test_identity_map(libraries):
    same = align.same_bytes((P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")))
    a, b = libraries("the house of the people 你")
    by = {raw: i for i, raw in b}
    agree = [(i, by[raw]) for i, raw in a if raw in by]
    assert len(agree) >= 4 and all(same[i] == j for i, j in agree)


def test_align_brute(spark, libraries):
    """Documents of a real table together with odd texts."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 2500").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(100_000 + i, t) for i, t in enumerate(odd_texts(300, 1))]
    want, count = brute([t for _, t in rows], libraries)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dict(as_rows(align.report(df)))
    assert got == {d: w[:7] for (d, _), w in zip(rows, want, strict=True)}
    assert sum(w[0] == 0 for w in want) > 20  # texts with U+2581
    pairs = {(r.pair >> 32, r.pair & 0xFFFFFFFF): r.n for r in align.pair_counts(align.slices_of(df)).collect()}
    assert pairs == count
    groups = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in align.groups(df).collect()}
    assert groups == {d: w[7] for (d, _), w in zip(rows, want, strict=True)}


def test_digest_runs(libraries, monkeypatch):
    """Digests that are spelled out in several runs."""
    monkeypatch.setattr(align, "DIGEST_TOKENS", 7)
    paths = align._paths(None, None)
    x = align.Aligned(pa.array(["the house, the people", "", "héllo wörld"]), paths)
    want, _ = brute(["the house, the people", "", "héllo wörld"], libraries)
    assert x.digests(align._spelled(paths), len(align.same_bytes(paths))) == [w[6] for w in want]
    assert np.diff(x.link_end, prepend=0).tolist() == [w[3] for w in want]


def test_align_edge(spark, edge, nothing, libraries):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    want, _ = brute([t for _, t in rows], libraries)
    got = as_rows(align.report(edge.where("text is null or length(text) < 20000")))
    assert collections.Counter(got) == collections.Counter((d, w[:7]) for (d, _), w in zip(rows, want, strict=True))
    assert (1, (0, 0, 0, 0, 0, 0, "")) in got and (2, (0, 0, 0, 0, 0, 0, "")) in got
    long = align.report(edge.where("length(text) >= 20000")).collect()
    assert len(long) == 1 and long[0].n_links >= max(long[0].n_a, long[0].n_b)
    assert align.report(nothing).count() == 0 and align.groups(nothing).count() == 0
