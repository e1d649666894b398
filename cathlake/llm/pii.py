"""Information-theoretic sanitisation of personal data.

Protected entities are the values of the base kinds (email, ip, card, phone).
A term is a white-space word without punctuation at its ends, in lower case.
The corpus tells how strongly a term reveals an entity e: with N words in all,
n(t) occurrences of t, n(e) mentions of e and n(e, t) mentions with t within
``WINDOW`` words on either side,

    PMI(e; t) = log2( n(e, t) / n(e)  /  min(1, n(t) * 2 * WINDOW / N) )
    IC(e)     = log2( N / (2 * WINDOW * n(e)) )

and t discloses PMI / IC of e: 1 if t is found next to e and nowhere else. A
pair needs ``MIN_CONTEXTS`` different texts, of which near-duplicates count as
one (the classes of ``minhash``), so that copies of one text prove nothing and a
name in a fixed phrase is supported by every text that holds it. Near a mention of e, terms that disclose ``GENERALISE`` or more
are replaced by a placeholder, from ``REMOVE`` on they are taken out; mentions
of the entities become the name of their kind.

Spans are code points, end exclusive. A base kind is matched leftmost and
non-overlapping; each matcher below is linear in the text.

Defined results: a null text is the empty text without spans (sanitising
leaves it null); spans of different kinds may overlap, terms never overlap
base spans; equal rows get equal spans; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import field, materialize, packed, row_key, ship, whole_text
from .minhash import members
from .quality import SPACE_RE

KINDS = ["email", "ip", "card", "phone", "term"]
WINDOW = 20
MIN_CONTEXTS = 3
GENERALISE = 0.8
REMOVE = 0.95
PLACEHOLDER = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}
PUNCTUATION = ".,;:!?()[]{}\"'<>|*#$%&=-"

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        # The local part is the run of its characters before the @; it holds no @, so each @ decides alone.
        head = text[last:at]
        start = last + len(head.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        last = m.end() if m else at + 1
        at = text.find("@", last)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def find(text: str) -> list[tuple[int, int, int]]:
    """Base spans (start, kind, end) by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(text: str, span: tuple[int, int, int]) -> bytes:
    """Identity of a mention: kind and value, without case and separators."""
    s, kind, e = span
    value = text[s:e].lower() if kind < 2 else _digits(text[s:e])
    return hashlib.md5(f"{kind}:{value}".encode()).digest()


def surroundings(text: str, spans: list[tuple[int, int, int]], window: int = WINDOW) -> Iterator[dict]:
    """The words near each mention, with the mention's entity and start."""
    if not spans:
        return
    taken = sorted((s, e) for s, _, e in spans)
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    every = [m.span() for m in WORD.finditer(text)]
    begin, finish = [a for a, _ in every], [b for _, b in every]

    def free(a, b):
        k = bisect_left(starts, b)
        return not k or reach[k - 1] <= a

    for span in spans:
        s, _, e = span
        # A word that the mention cuts counts with what is left of it on either side.
        i, j = bisect_left(begin, s), bisect_right(finish, e)
        left = [(a, min(b, s)) for a, b in every[max(0, i - window):i]]
        right = [(max(a, e), b) for a, b in every[j:j + window]]
        words = [w for w in left + right if free(*w)]
        who = entity(text, span)
        for a, b in words:
            yield {"entity": who, "at": s, "word": text[a:b], "start": a, "end": b}


FOUND = ("doc_id long, key binary, kind array<int>, start array<int>, end array<int>, "
         "near array<struct<entity: binary, at: int, word: string, start: int, end: int>>")


def detect(src: DataFrame) -> DataFrame:
    """Base spans and the words near them, for (doc_id, key, text)."""
    near = pa.struct([("entity", pa.binary()), ("at", pa.int32()), ("word", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for b in batches:
            spans, words = [], []
            for text in b.column(2).to_pylist():
                found = find(text)
                spans.append(found)
                words.append(list(surroundings(text, found)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([[x[1] for x in s] for s in spans], ints),
                 pa.array([[x[0] for x in s] for s in spans], ints), pa.array([[x[2] for x in s] for s in spans], ints),
                 pa.array(words, pa.list_(near))], ["doc_id", "key", "kind", "start", "end", "near"])

    return src.mapInArrow(run, FOUND)


def term(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(PUNCTUATION)))


def supported(told: DataFrame, near: DataFrame, src: DataFrame) -> DataFrame:
    """The pairs of ``told`` found in ``MIN_CONTEXTS`` texts that are no near-duplicates of each other."""
    where = materialize(near.join(told, ["entity", "term"]).select("entity", "term", "key").distinct(), "where")
    texts = materialize(src.join(where.select("key").distinct(), "key", "left_semi"), "supporting")
    alike = materialize(members(texts).select("key", "comp").distinct(), "alike")
    enough = where.join(alike, "key").select("entity", "term", "comp").distinct().groupBy("entity", "term") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_CONTEXTS)
    return told.join(enough, ["entity", "term"], "left_semi")


def occurrences(src: DataFrame) -> DataFrame:
    """(word, n) over the distinct rows of ``src`` (doc_id, key, text), as the mentions are counted.

    Only the texts of repeated rows are shuffled: their surplus counts negative.
    """
    def words(texts: DataFrame) -> DataFrame:
        return texts.select("n", F.explode(F.split("text", SPACE_RE)).alias("word")).where("word != ''") \
            .groupBy("word").agg(F.sum("n").alias("n"))

    again = src.groupBy("key").agg((1 - F.count(F.lit(1))).alias("n")).where("n < 0")
    again = materialize(again, "repeated-keys")
    surplus = src.join(again, "key").groupBy("key", "n").agg(F.any_value("text").alias("text"))
    return words(src.select(F.lit(1).cast("long").alias("n"), "text")).unionByName(words(surplus)) \
        .groupBy("word").agg(F.sum("n").alias("n"))


def disclosures(near: DataFrame, src: DataFrame) -> DataFrame:
    """(entity, term, share) of the pairs that reach ``GENERALISE``.

    ``near``: entity, term, key, mention (one row per word near a mention);
    ``src``: doc_id, key, text of the whole corpus.
    """
    pairs = near.groupBy("entity", "term", "key").agg(F.countDistinct("mention").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("texts"))
    pairs = materialize(pairs.where(F.col("texts") >= MIN_CONTEXTS).drop("texts"), "pairs")
    mentions = near.select("entity", "mention").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    counts = materialize(occurrences(src).groupBy(term(F.col("word")).alias("term")).agg(F.sum("n").alias("n_t")), "terms")
    total = counts.agg(F.sum("n_t").cast("double").alias("total"))
    both = pairs.join(counts, "term").join(materialize(mentions, "mentions"), "entity")
    n = total.scalar()
    pmi = F.log2((F.col("n_et") / F.col("n_e")) / F.least(F.lit(1.0), F.col("n_t") * (2 * WINDOW) / n))
    ic = F.log2(n / (2 * WINDOW * F.col("n_e")))
    told = both.where(ic > 0).withColumn("share", F.least(F.lit(1.0), pmi / ic)) \
        .where(F.col("share") >= GENERALISE).select("entity", "term", "share")
    return supported(materialize(told, "disclosing"), near, src)


def _source(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    whole = whole_text(F.col(f"`{text}`"))
    ids = F.col(f"`{doc_id}`").cast("long")
    return docs.select(ids.alias("doc_id"), row_key(ids, whole).alias("key"), whole.alias("text"))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, key, ``base`` and ``every``: arrays of (start, kind, end, share); share is null for base spans."""
    ship(docs.sparkSession)
    src = _source(docs, text, doc_id)
    found = materialize(detect(src), "found")
    word = F.explode("near").alias("w")
    near = found.where(F.size("near") > 0).select("key", word).select(
        "key", "w.*", term(F.col("w.word")).alias("term"),
        F.xxhash64("key", "w.entity", "w.at").alias("mention")).where("term != ''")
    told = materialize(disclosures(near.select("entity", "term", "key", "mention"), src), "told")
    hits = near.join(told, ["entity", "term"]).groupBy("key", "start", "end").agg(F.max("share").alias("share"))
    hits = hits.groupBy("key").agg(F.collect_list(F.struct(
        "start", F.lit(KINDS.index("term")).alias("kind"), "end", "share")).alias("terms"))
    hits = materialize(hits, "hits")
    base = F.transform(F.arrays_zip("start", "kind", "end"), lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(None).cast("double").alias("share")))
    out = found.join(hits, "key", "left").select("doc_id", "key", F.sort_array(base).alias("base"), "terms")
    return out.select("doc_id", "key", "base", F.sort_array(F.concat(
        "base", F.coalesce("terms", F.array().cast("array<struct<start:int,kind:int,end:int,share:double>>")))).alias("every"))


def written(col: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(col, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all spans."""
    s = spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return s.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                    written(F.col("every")).alias("spans"))


def replaced(text: str, found: list) -> str:
    """The text with spans (start, kind, end, share) replaced; of overlapping spans the union goes under the first's name."""
    out, at, i = [], 0, 0
    while i < len(found):
        s, kind, e, share = (found[i][k] for k in ("start", "kind", "end", "share"))
        while i + 1 < len(found) and found[i + 1]["start"] < e:
            i += 1
            e = max(e, found[i]["end"])
        out.append(text[at:s])
        out.append("" if share is not None and share >= REMOVE else PLACEHOLDER[KINDS[kind]])
        at, i = e, i + 1
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with personal data replaced in the text; all other columns as they were."""
    marks = spans(docs, text, doc_id).where(F.size("every") > 0).groupBy("key").agg(F.any_value("every").alias("_cl_spans"))
    marks = materialize(marks.withColumnRenamed("key", "_cl_key"), "marks")
    rows = packed(docs).withColumn("_cl_key", row_key(field(doc_id).cast("long"), whole_text(field(text)))) \
        .join(marks, "_cl_key", "left")
    cols = [field(text).alias("_cl_text") if c == text else field(c).alias(f"_cl_c{i}") for i, c in enumerate(docs.columns)]
    at, n = docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [replaced(t, s) if s else t for t, s in zip(b.column(at).to_pylist(), b.column(n).to_pylist(), strict=True)]
            cells = [pa.array(new, pa.string()) if i == at else b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays(cells, b.schema.names[:n])

    flat = rows.select(*cols, "_cl_spans")
    out = flat.mapInArrow(run, flat.drop("_cl_spans").schema)
    return out.toDF(*docs.columns)
