"""Operators over documents: edge cases, then brute force over a whole small table."""

import collections
import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from cathlake.llm import bpe, lines, minhash, packing, passages, pii, quality
from edge_docs import SF_SMALL, edge, nothing  # noqa: F401


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def same_rows(got, want):
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


# --- 9 quality rules ---

def test_quality_edge(edge, nothing):
    got = quality.report(edge.select("doc_id", "text", "kept")).collect()
    assert len(got) == 13
    for r, t in zip(sorted(got, key=lambda r: (r.n_words, r.doc_id or 0)),
                    sorted((x.text for x in edge.collect()), key=lambda t: len(brute.words(t))), strict=True):
        assert r.n_words == len(brute.words(t))
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.report(nothing).count() == 0 and quality.keep_good(nothing).columns == nothing.columns
    good = quality.keep_good(edge)
    assert good.columns == edge.columns
    assert {r.doc_id for r in good.select("doc_id").collect()} == {4, 5, 6, 7, 8, 9, None}
    assert good.where("doc_id = 8").count() == 3


def test_quality_measures(spark):
    rng = random.Random(1)
    rows = ["a b c a b c", "a a a a", "x\nx\n\n x\n", "#*$ %&|<>", "a\x0bb\x0cc\td", "é é é é è", "a b c d a b c", "A B"]
    rows += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(40)]
    got = quality.report(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(rows[r.doc_id]), rows[r.doc_id]


def test_quality_order_never_changes_verdicts(docs):
    rs = list(quality.rules())
    m = quality.measures(quality.packed(docs.select("doc_id", "text")), quality.field("text"))
    a = m.withColumn("f", quality.first_failure(rs)).where("f is null").count()
    b = m.withColumn("f", quality.first_failure(rs[::-1])).where("f is null").count()
    assert a == b == quality.keep_good(docs).count()


# --- 1 line dedup ---

def test_lines_edge(edge, nothing):
    out = lines.clean(edge)
    same_rows(out, edge)  # no line is on five sites
    assert lines.clean(nothing).count() == 0


def test_lines_brute(spark):
    rng = random.Random(2)
    pool = [f"line {i}" for i in range(12)]
    rows = [(d, "\n".join(rng.choice(pool + ["", "  ", f"own {d}"]) for _ in range(rng.randrange(8))), f"s{rng.randrange(7)}")
            for d in range(60)]
    out = lines.clean(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=4)
    assert {r.doc_id: r.text for r in out.collect()} == brute.boilerplate(rows, 4)


# --- 3 near duplicates ---

def test_near_edge(edge, nothing):
    got = minhash.classes(edge).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[r.class_id].add(r.doc_id)
    assert by[5] == {5, 6, 7} and by[1] == {1, 2}  # a null text is the empty text
    assert sum(r.keep for r in got if r.class_id == 5) == 1
    kept = minhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = collections.Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == collections.Counter([1, 3, 4, 5, 8, None, 9, 10])
    assert minhash.classes(nothing).count() == 0 and minhash.keep_one(nothing).count() == 0


def test_near_brute(docs, texts):
    got = collections.defaultdict(set)
    for r in minhash.classes(docs).collect():
        got[r.class_id].add(r.doc_id)
    assert {frozenset(v) for v in got.values()} == brute.near_classes(texts)


def test_near_hub_and_apart(spark):
    """Members of one bucket that miss its head must still find each other."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(200)] = f"x{d}_{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    got = collections.defaultdict(set)
    for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.class_id].add(r.doc_id)
    want = brute.near_classes(dict(rows))
    assert {frozenset(v) for v in got.values()} == want


def test_near_repeats_inside(spark):
    """Copies that repeat a passage 20 to 100 times have the same shingles and are found."""
    rng = random.Random(11)
    rows = []
    for g in range(40):
        w = [f"g{g}_{i}" for i in range(104)]
        at, size = rng.randrange(60), rng.randrange(20, 40)
        rows.append((len(rows), " ".join(w)))
        rows.append((len(rows), " ".join(w[:at] + w[at:at + size] * rng.randrange(20, 101) + w[at + size:])))
    got = collections.defaultdict(set)
    for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.class_id].add(r.doc_id)
    assert {frozenset(v) for v in got.values()} == brute.near_classes(dict(rows))


def test_one_bits_of_short_texts():
    """At the threshold the one-bit cut keeps short texts, whose few shingles win many slots each."""
    n = 1000
    h = np.random.default_rng(2).integers(1, 2**63, (n, 10)).astype(np.uint64)
    row = np.repeat(np.arange(n), 10)
    whole = minhash.one_bits(minhash.signatures(row, h.ravel(), np.ones(n * 10), n))
    part = minhash.one_bits(minhash.signatures(np.repeat(np.arange(n), 8), h[:, :8].ravel(), np.ones(n * 8), n))
    apart = [sum(bin(int(x)).count("1") for x in r) for r in (whole ^ part).view(np.uint64)]
    assert max(apart) <= minhash.MAX_APART + 3 and sum(x > minhash.MAX_APART for x in apart) <= 1


def near_copies(rng, n, words=200, edits=(0, 16)):
    """Copies of one text with words of their own at random places."""
    base = [f"b{i}" for i in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for at in rng.sample(range(words), rng.randrange(*edits)):
            t[at] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(t))
    return out


def test_near_still_apart(spark):
    """Large groups around the threshold: classes equal brute force, pairs on differences to the head do not grow with the square."""
    made = []
    for n in (100, 400):
        rng = random.Random(n)
        texts = sorted(set(near_copies(rng, n)))
        th = [hashlib.md5(t.encode()).digest() for t in texts]
        head = min(range(len(texts)), key=lambda i: len(brute.shingle_set(texts[i])))
        rest = spark.createDataFrame([(t, th[head], t) for t in th], "th binary, hth binary, comp binary")
        pairs = {(bytes(r.a), bytes(r.b)) for r in minhash.difference_pairs(
            rest, spark.createDataFrame(list(zip(th, texts, strict=True)), "th binary, text string")).collect()}
        made.append(len(pairs) / len(texts))
        sets = [brute.shingle_set(t) for t in texts]
        near = [i for i in range(len(texts)) if brute.jaccard(sets[i], sets[head]) >= 0.8]
        for i in range(len(texts)):
            for j in range(i):
                # A link that the head does not make must be among the pairs.
                if i != head != j and not (i in near and j in near) and brute.jaccard(sets[i], sets[j]) >= 0.8:
                    assert (min(th[i], th[j]), max(th[i], th[j])) in pairs
    assert max(made) < 4  # all pairs would be 50 and 200 a text
    rows = list(enumerate(near_copies(random.Random(7), 200, edits=(0, 20))))
    got = collections.defaultdict(set)
    for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.class_id].add(r.doc_id)
    assert {frozenset(v) for v in got.values()} == brute.near_classes(dict(rows))


def test_probminhash_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    h = rng.integers(1, 2**63, 300).astype(np.uint64)
    wa, wb = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    a, b = np.arange(0, 220), np.arange(80, 300)
    row = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
    sig = minhash.signatures(row, np.concatenate([h[a], h[b]]), np.concatenate([wa[a], wb[b]]), 2, 4096)
    va, vb = np.zeros(300), np.zeros(300)
    va[a], vb[b] = wa[a], wb[b]
    both = np.flatnonzero((va > 0) & (vb > 0))
    jp = sum(1 / np.maximum(va / va[i], vb / vb[i]).sum() for i in both)
    assert abs((sig[0] == sig[1]).mean() - jp) < 0.03


# --- 2 personal data ---

def test_pii_base_fuzz():
    rng = random.Random(4)
    for _ in range(5000):
        t = "".join(rng.choice("a1.@-+ ()5_9\n%é") for _ in range(rng.randrange(60)))
        assert pii.find(t) == brute.base_spans(t), t
    assert pii.find("a" * 200_000 + "@") == [] and pii.find("1" * 200_000) == []


def test_pii_edge(edge, nothing):
    got = pii.report(edge.select("doc_id", "text", "spans")).collect()
    assert len(got) == 13 and sum(r.n_email for r in got) == 1
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if not r.n_email)
    out = pii.sanitise(edge)
    assert out.columns == edge.columns
    texts = {r.n: (r.text, r.spans) for r in out.collect()}
    assert texts["n-11"][0].startswith("mail <EMAIL> now") and texts["n-0"] == (None, "spans-0")
    assert pii.sanitise(nothing).count() == 0 and pii.report(nothing).count() == 0


def test_pii_terms(spark):
    """A name that only stands next to one address discloses it; common words do not."""
    rng = random.Random(6)
    rows = []
    for d in range(400):
        w = [f"c{rng.randrange(50)}" for _ in range(60)]
        if d % 40 == 0:
            w[30:33] = [f"c{rng.randrange(50)}", "Zorblax,", "z.b@mail.example.org"]
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.report(df).collect():
        found = [x.split(":") for x in r.spans.split(",") if x]
        text = rows[r.doc_id][1]
        named = {text[int(s):int(e)] for k, s, e in found if k == "term"}
        assert named == ({"Zorblax,"} if r.doc_id % 40 == 0 else set())
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Zorblax" not in out[0] and "<EMAIL>" in out[0] and out[1] == rows[1][1]


def test_pii_fixed_phrase(spark):
    """A fixed signature line in different documents gives its terms; copies of one text do not."""
    rng = random.Random(7)
    rows = []
    for d in range(400):
        w = [rng.choice(["Contact", "at", f"c{rng.randrange(50)}"]) for _ in range(80)]
        if d % 40 == 0:
            w[30:30] = "Contact Jane Doe at jane@x.com".split()
        rows.append((d, " ".join(w)))
    one = [f"c{rng.randrange(50)}" for _ in range(120)]
    one[60:60] = ["Quuxley", "q@y.example.org"]
    for d in range(400, 408):
        copy = list(one)
        copy[59], copy[62], copy[5] = (f"c{rng.randrange(50)}" for _ in range(3))
        rows.append((d, " ".join(copy)))
    for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = rows[r.doc_id][1]
        named = [text[int(s):int(e)] for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k == "term"]
        assert named == (["Jane", "Doe"] if r.doc_id < 400 and r.doc_id % 40 == 0 else []), r


def test_pii_window_and_counts(spark):
    """Twenty words on either side however long they are; repeated rows count once."""
    long = [f"https://x.org/{k}/" + "y" * 900 for k in range(30)]
    text = " ".join([*long, "q@y.example.org", *long])
    near = list(pii.surroundings(text, pii.find(text)))
    assert [x["word"] for x in near] == long[-20:] + long[:20]
    assert all(text[x["start"]:x["end"]] == x["word"] for x in near)
    text = "a <mailto:q@y.example.org>, b +491234567890 c"
    assert [x["word"] for x in pii.surroundings(text, pii.find(text)[:1])] == ["a", "<mailto:", ">,", "b", "+491234567890", "c"]
    assert [x["word"] for x in pii.surroundings(text, pii.find(text))] == ["a", "<mailto:", ">,", "b", "c", *"abcabc"]
    rows = [(1, "a b a"), (1, "a b a"), (1, "a b a"), (2, "a c"), (1, "a c")]
    src = pii._source(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")
    assert dict(map(tuple, pii.occurrences(src).collect())) == {"a": 4, "b": 1, "c": 2}


# --- 8 byte-level BPE ---

def rank_encoding():
    import base64

    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, docs, edge, nothing, texts):
    enc, rng = rank_encoding(), random.Random(7)
    rows = ["", None, "a  b", " a", "a \n b", "x\x01y", "it's we'll", "naïve café 😀 𝔘", "<|endoftext|>", "a b   c", "\t\t"]
    rows += ["".join(rng.choice("ab .,\n\t'é😀1\x85\x1c-") for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in bpe.decode(bpe.encode(df, offsets=True)).collect():
        t = rows[r.doc_id] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == enc.encode_ordinary(t), repr(t)
        assert bytes(r.decoded) == t.encode()
        assert len(r.starts) == len(ids) and all(enc.decode_single_token_bytes(i) in t[s:e].encode()
                                                 for i, s, e in zip(ids, r.starts, r.ends, strict=True))
    once = {r.doc_id: bytes(r.decoded) for r in bpe.encode(df, decoded=True).collect()}
    assert once == {i: (t or "").encode() for i, t in enumerate(rows)}
    out = bpe.encode(edge.select("doc_id", "text", "ids", "hash"))
    assert out.columns == ["doc_id", "hash", "ids"] and out.count() == 13
    assert bpe.decode(bpe.encode(nothing)).count() == 0
    for r in bpe.encode(docs.select("doc_id", "text")).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(texts[r.doc_id])


# --- 10 packing ---

def check_packing(rows, texts, capacity=4096):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want, total = collections.Counter(), 0
    for d, text in texts:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[d, k, s, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seqs = collections.defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs), -(-total // capacity)


def test_packing(spark, docs, edge, nothing, texts):
    n, least = check_packing(packing.pack(docs).collect(), list(texts.items()))
    assert n <= least * 1.03 + 1
    check_packing(packing.pack(edge).collect(), [(r.doc_id, r.text) for r in edge.collect()])
    assert packing.pack(nothing).count() == 0
    odd = ["İstanbul ΣΑΣ", "J̌É ,.a.,b", "a\x1cb c", "it's don't", "<|endoftext|> x", "..., a.b.c", "1234 ½"]
    check_packing(packing.pack(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect(), list(enumerate(odd)))


def test_packing_plans():
    rng = random.Random(8)
    for _ in range(20):
        lengths = [rng.randint(513, 4096) for _ in range(rng.randint(1, 400))]
        counts = dict(collections.Counter(lengths))
        plan, n = packing.plan_large(counts)
        lengths.sort(reverse=True)
        load = collections.Counter()
        for rank, s in enumerate(lengths):
            k = int(np.searchsorted(plan[:, 0], rank, "right")) - 1
            load[int(plan[k, 1]) + rank - int(plan[k, 0])] += s
        assert max(load.values()) <= 4096 and len(load) == n
        small = sorted((rng.randint(1, 512) for _ in range(300)), reverse=True)
        free = sorted(4096 - x for x in load.values())
        fill, _ = packing.plan_small(dict(collections.Counter(small)), dict(collections.Counter(free)))
        room = collections.defaultdict(lambda: 4096, enumerate(free))
        for rank, s in enumerate(small):
            k = int(np.searchsorted(fill[:, 0], rank, "right")) - 1
            room[int(fill[k, 1]) + rank - int(fill[k, 0])] -= s
        assert min(room.values()) >= 0


# --- 7 repeated passages ---

def test_passages_edge(edge, nothing):
    got = {r.doc_id for r in passages.report(edge).collect()}
    assert got == {5, 6, 7, 8}
    out = passages.cut(edge)
    assert out.columns == edge.columns and out.count() == 13
    assert passages.report(nothing).count() == 0 and passages.cut(nothing).count() == 0


def test_passages_planted(spark):
    """Every shared passage of 51 words is found, inside paragraphs and across lines; other texts stay clean."""
    rng = random.Random(9)

    def own(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    rows, planted = [], set()
    for g in range(12):
        passage = own(51)
        if g % 2:
            passage[20] += "\n"
        for _ in range(2):
            planted.add(len(rows))
            rows.append((len(rows), " ".join(own(rng.randrange(5, 90)) + passage + own(rng.randrange(5, 90)))))
    for _ in range(12):
        rows.append((len(rows), " \x01 ".join(own(200))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in passages.report(df).collect()}
    assert set(got) == planted
    assert all(got[d].cluster == d - d % 2 for d in planted)
    cut = {r.doc_id: r.text for r in passages.cut(df).collect()}
    assert all((len(cut[d]) < len(rows[d][1])) != (len(cut[d + 1]) < len(rows[d + 1][1])) for d in range(0, 24, 2))
    assert all(cut[d] == rows[d][1] for d in range(24, 36))


def test_passages_whole_span(spark):
    """All words of a shared passage are reported and cut, also where two of three documents share more."""
    rng = random.Random(10)

    def own(n):
        return [f"u{rng.randrange(10**9)}" for _ in range(n)]

    rows, want = [], []
    for g in range(15):
        passage = own(rng.randrange(51, 140))
        inner = passage[:51] if g % 3 else passage
        for p in [passage, passage, inner][:2 + bool(g % 2)]:
            head = " ".join(own(rng.randrange(5, 90))) + " "
            rows.append((len(rows), head + " ".join(p + own(rng.randrange(5, 90)))))
            want.append(f"{len(head)}:{len(head) + len(' '.join(p))}")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in passages.report(df).collect()}
    assert [got[d].spans for d in range(len(rows))] == want
    cut = {r.doc_id: r.text for r in passages.cut(df).collect()}
    kept = collections.Counter(w for t in cut.values() for w in t.split())
    assert kept == collections.Counter({w for _, t in rows for w in t.split()})  # every word stays once


def test_passages_variants_give_no_pairs_of_all(spark, monkeypatch):
    """60 variants of a paragraph with one edit each are too far apart to link: no pair of each two is compared."""
    rng = random.Random(7)
    base = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join([*base[:i], f"own{i}", *base[i + 1:]])) for i in range(60)], "doc_id long, text string")
    tried, verify = [], passages._verified

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(passages, "_verified", counted)
    passages.report(df).collect()
    assert len(tried) == 2 and tried[1] <= 60  # 220 by prefixes


def test_passages_extension_rounds(spark):
    """Copies that go on alike for 3, 5 and all words are told apart in one pass; the first document keeps each run."""
    window = [f"w{i}" for i in range(60)]
    tails = [[f"t{j}" for j in range(12)], [f"t{j}" for j in range(3)] + ["x1", "x2"], [f"t{j}" for j in range(3)] + ["x1", "y2"], [f"t{j}" for j in range(12)]]
    own = [[f"own{i}x{j}" for j in range(120)] for i in range(4)]
    rows = [(i, " ".join([*own[i][:60], *window, *t, *own[i][60:]])) for i, t in enumerate(tails)]
    got = {r.doc_id: r for r in passages.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: r.repeated_words for d, r in got.items()} == {0: 72, 1: 64, 2: 64, 3: 72}


def test_word_spans():
    texts = ["", "a", " \x0b", "ü b\x1fc\n\u3000d e\xa0", "x\ty", "ends here", "here"]
    start, end, first = passages.word_spans(pa.array(["skipped", *texts])[1:])
    for i, t in enumerate(texts):
        own = slice(first[i], first[i + 1])
        assert list(zip(start[own].tolist(), end[own].tolist(), strict=True)) == [m.span() for m in passages.WORD.finditer(t)]


def test_passages_near_paragraphs(docs, texts):
    par = [(d, brute.shingle_set(x)) for d, t in texts.items() for x in t.split("\n") if len(brute.words(x)) >= passages.MIN_PARAGRAPH]
    near = set()
    for i, (a, s) in enumerate(par):
        for b, t in par[i + 1:]:
            if a != b and brute.jaccard(s, t) >= 0.8:
                near |= {a, b}
    got = {r.doc_id for r in passages.report(docs).collect()}
    assert near <= got


def test_bands_reach_the_recall():
    b, r = passages.tune_bands()
    assert 1 - (1 - 0.8 ** r) ** b >= passages.RECALL and b * r <= 48
