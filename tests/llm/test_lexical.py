"""Ranked lexical search against scores of all documents."""

import collections
import math
import random
import re

import numpy as np
import pytest
from cathlake.llm import lexical
from edge_docs import SF_SMALL, edge, nothing  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score) over lists of (id, text)."""
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b, b.total()) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((-s, d is not None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms():
    texts = ["", "A b_C", "é-É ß", "x\u0080y z", "1.5e+3", "\x00a\x7fb", "ÀB 你好,世界"]
    for t in texts:
        assert [x.decode() for x in lexical.terms_of(t.encode())] == terms(t)


def test_lexical_brute(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = rows(lexical.rank_documents(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


@pytest.mark.parametrize("block_docs", [8, 64])
def test_lexical_blocks(spark, monkeypatch, block_docs):
    """Many slices and blocks, few distinct scores: ties at every rank."""
    monkeypatch.setattr(lexical, "SMALL", 3)
    rng = random.Random(block_docs)
    docs = [(i, " ".join(f"t{int(30 * rng.random() ** 2)}" for _ in range(rng.choice([3, 3, 3, 8])))) for i in range(1500)]
    items = [(i, " ".join(f"T{rng.randrange(34)}," for _ in range(rng.randrange(1, 6)))) for i in range(12)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical.rank_documents(d, q, 20, block_docs)) == brute(docs, items, 20)


def topical(n, topics=12, own=60, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        topic = rng.randrange(topics)
        words = [f"common{int(40 * rng.random() ** 2)}" for _ in range(30)] + [f"topic{topic}x{rng.randrange(own)}" for _ in range(20)]
        out.append((i, " ".join(words)))
    return out


def test_bounds_hold_and_skip():
    """No document scores above its block's bound, and blocks of other topics are skipped."""
    docs = topical(3000)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, x in docs for t in terms(x)}))}
    bags = [collections.Counter(vocabulary[t] for t in terms(x)) for _, x in docs]
    end = np.cumsum([len(b) for b in bags])
    term = np.array([t for b in bags for t in sorted(b)])
    gain = np.array([10 ** 9 * b[t] // (1000 * b[t] + 2000) for b in bags for t in sorted(b)])
    df = np.bincount(term, minlength=len(vocabulary))
    weight = np.floor(1000 * np.log(6002 / (2 * df + 1))).astype(np.int64)
    s = lexical.Slice(lexical.build_slice([d for d, _ in docs], end, term, gain, weight, 64))
    query = np.array(sorted([vocabulary[f"topic3x{i}"] for i in range(12)] + [vocabulary[f"common{i}"] for i in (0, 20)]))
    own = np.zeros(len(weight), np.int64)
    own[query] = weight[query]
    blocks = s.blocks(query)
    assert sorted(s.docs_of(blocks)[0].tolist()) == sorted(i for t in query for i, b in enumerate(bags) if t in b)
    for b, bound in zip(blocks, s.bounds(blocks, own), strict=True):
        assert 0 < len(s.docs_of(np.array([b]))[0]) <= 64
        assert s.scores(s.docs_of(np.array([b]))[0], own).max() <= bound
    best = lexical.Best(np.ones(1, np.int64), 10)
    scored = lexical.search_slice(s, [query], weight, best, False)
    every = sorted(zip((-s.scores(np.arange(3000), own)).tolist(), range(3000), strict=True))[:10]
    assert best.held[0] == every
    assert scored < len(np.unique(s.docs_of(blocks)[0])) / 2


def test_lexical_edge(spark, edge, nothing):
    docs = edge.withColumnRenamed("a", "item_id")
    rows_ = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(None, rows_[4][1]), (1, None), (2, ""), (3, " .,"), (4, "other, ONE two"), (4, "other, ONE two"), (5, "nowhere-else"),
             (6, rows_[3][1])]
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    assert rows(lexical.rank_documents(docs, q)) == brute(rows_, items)
    assert lexical.rank_documents(nothing, q).count() == 0
    assert lexical.rank_documents(docs, q.limit(0)).count() == 0
