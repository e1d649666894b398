"""Ranked lexical search with per-term geometric blocking.

Documents are sparse vectors of term gains; a query's score adds the weighted
gains of its terms. The index holds, for slices of documents,

* the documents' vectors,
* each term's posting list, clustered by similarity of the documents (nearest
  of a few representatives of the list, in a random projection of the
  vectors) and cut into blocks of at most ``BLOCK_DOCS`` documents,
* for each block the coordinatewise maximum of its documents' vectors. Blocks
  of fewer than ``SMALL`` documents are bounded by their vectors themselves.

A block's bound for a query is the query's score of the block's summary: no
document of the block scores higher. Every matching document is in a block of
a list of the query, so a block may be skipped if, and only if, its bound is
below the k-th best score known; ties are kept. Search goes in two rounds:

1. each slice evaluates the best block of each query; the k-th best of all
   these scores is a floor for the query's k-th score;
2. each slice takes the blocks that reach the floor, best bound first, and
   evaluates their documents; a task raises the floor as it finds better ones.

Scores are 64-bit integers throughout; floating point only decides which
documents share a block. The index covers the terms of the query set, as
gains of other terms never count, and all documents and whole texts.

Queries are taken ``QUERY_BLOCK`` at a time; their terms, weights and floors
are all that the driver holds and tasks are sent.

Defined results: a null text has no terms; N and L count documents with terms
only. Queries without terms give no rows; repeated queries are ranked each
for itself, repeated documents each take a rank, documents without id come
before others of equal score. Empty tables give no rows. Of the caller's
columns only the ids and texts are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cathlake.operators.numbering import dense_ids
from cathlake.session import checkpoint_dir

from .common import arrow_batches, file_system, gather, materialize, planes, ship, unplanes, whole_text
from .tokens import slices

K = 50
BLOCK_DOCS = 512
SMALL = 32
SLICE_POSTINGS = 150_000    # postings of a slice of the index
DIMENSIONS = 16             # of the projection in which documents are compared
ENTRIES = 1_000_000         # vector entries summarised at a time
QUERY_BLOCK = 10_000

# Letters and digits of ASCII and all bytes of other characters belong to terms; capitals are folded.
TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                   for c in range(256))

FORWARD = "doc_id long, n long, terms binary, tfs binary"
INDEX = pa.schema([("doc_ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in (
    "doc_end", "doc_term", "doc_gain", "block_term", "block_end", "block_docs", "summary_end", "summary_term", "summary_gain")]])
MANIFEST = "part int, path string, n_slices long, n_docs long"


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a text's UTF-8 bytes."""
    return raw.translate(TERM_BYTES).split()


# --- documents ------------------------------------------------------------

def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its number of terms, and the numbers and counts of those in the vocabulary."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for b in batches:
            for at, texts in slices(b.column(1)):
                found = [terms_of(t) for t in texts.cast(pa.binary()).to_pylist()]
                n = np.fromiter(map(len, found), np.int64, len(found))
                number = np.fromiter((vocabulary.get(t, -1) for ts in found for t in ts), np.int64, int(n.sum()))
                key = (np.repeat(np.arange(len(n)), n) * size + number)[number >= 0]
                key, tf = np.unique(key, return_counts=True)
                cut = np.searchsorted(key, np.arange(1, len(n)) * size)
                parts = [[x.astype("<u4").tobytes() for x in np.split(v, cut)] for v in (key % max(size, 1), tf)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(n)), pa.array(n), *[pa.array(p, pa.binary()) for p in parts]],
                                                 ["doc_id", "n", "terms", "tfs"])

    ship(docs.sparkSession)
    with arrow_batches(docs.sparkSession):
        return materialize(df.mapInArrow(run, FORWARD), "lexical-forward")


def weights(fwd: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term of the vocabulary, the number of documents with terms, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            raw = b"".join(b.column(0).to_pylist())
            df += np.bincount(np.frombuffer(raw, "<u4"), minlength=size)
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(df[t])], ["term", "df"])

    n_docs, n_terms = fwd.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    out = np.array([math.floor(1000 * math.log(2 * n_docs + 2))] * size, np.int64)
    for r in fwd.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    return out, n_docs, n_terms


# --- index ----------------------------------------------------------------

def _steps(rising: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Differences of numbers that rise within each row."""
    out = np.diff(rising, prepend=0)
    first = np.concatenate([[0], end[:-1]])[np.diff(end, prepend=0) > 0]
    out[first] = rising[first]
    return out


def _unsteps(steps: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps, dtype=np.int64)
    start = np.concatenate([[0], end[:-1]])
    before = np.concatenate([[0], total])[start]
    return (total - np.repeat(before, end - start)).astype(np.uint32)


def _sketches(end: np.ndarray, term: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Unit vectors of a random projection of the documents, which keeps their inner products roughly."""
    start = np.concatenate([[0], end[:-1]])
    axes = np.random.default_rng(0).standard_normal((DIMENSIONS, size)).astype(np.float32)
    out = np.stack([np.add.reduceat(value * a[term], start) for a in axes], 1)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _clustered(docs: np.ndarray, sketch: np.ndarray, block_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """A list's documents by cluster, nearest to its representative first, and the block ends."""
    heads = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // block_docs)).astype(np.int64)]
    near = sketch[docs] @ sketch[heads].T
    cluster = near.argmax(1)
    order = np.lexsort((-near[np.arange(len(docs)), cluster], cluster))
    n = np.bincount(cluster)
    ends = [e for c in n[n > 0].tolist() for e in [*range(block_docs, c, block_docs), c]]
    first = np.repeat(np.cumsum(n[n > 0]) - n[n > 0], [-(-c // block_docs) for c in n[n > 0].tolist()])
    return docs[order], np.array(ends) + first


def summaries(block_of: np.ndarray, docs: np.ndarray, n_blocks: int, end: np.ndarray, term: np.ndarray, gain: np.ndarray,
              size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """End, terms and gains of the coordinatewise maximum of each block's documents."""
    start = np.concatenate([[0], end[:-1]])
    lens = end - start
    at = np.concatenate([[0], np.cumsum(np.bincount(block_of, lens[docs], n_blocks).astype(np.int64))])
    first = np.searchsorted(block_of, np.arange(n_blocks + 1))
    counts, terms, gains, b = np.zeros(n_blocks, np.int64), [], [], 0
    while b < n_blocks:
        e = max(b + 1, int(np.searchsorted(at, at[b] + ENTRIES, "right")) - 1)
        e = min(e, b + max(1, 4 * ENTRIES // max(size, 1)))
        part = docs[first[b]:first[e]]
        top = np.zeros((e - b) * size, np.int64)
        base = np.repeat((block_of[first[b]:first[e]] - b) * size, lens[part])
        np.maximum.at(top, base + gather(term, start, lens, part)[0], gather(gain, start, lens, part)[0])
        k = np.flatnonzero(top)
        counts[b:e] = np.bincount(k // size, minlength=e - b)
        terms.append((k % size).astype(np.uint32))
        gains.append(top[k].astype(np.uint32))
        b = e
    none = [np.zeros(0, np.uint32)]
    return np.cumsum(counts), np.concatenate(terms or none), np.concatenate(gains or none)


def build_slice(doc_ids: list, end: np.ndarray, term: np.ndarray, gain: np.ndarray, weight: np.ndarray, block_docs: int) -> list:
    """A slice of the index. Every document has at least one term."""
    size = len(weight)
    sketch = _sketches(end, term, (weight[term] * gain).astype(np.float32), size)
    of = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
    order = np.argsort(term, kind="stable")
    listed = of[order]
    list_end = np.cumsum(np.bincount(term, minlength=size))
    docs, ends, terms = [], [], []
    for t in np.unique(term).tolist():
        part = listed[list_end[t - 1] if t else 0:list_end[t]]
        part, cut = _clustered(part, sketch, block_docs) if len(part) > block_docs else (part, np.array([len(part)]))
        docs.append(part)
        ends.append(cut + (list_end[t - 1] if t else 0))
        terms += [t] * len(cut)
    docs, ends = np.concatenate(docs), np.concatenate(ends)
    n = np.diff(ends, prepend=0)
    big = n >= SMALL
    block = np.repeat(np.arange(len(n)), n)
    kept = big[block]
    number = np.cumsum(big) - 1
    s_end, s_term, s_gain = summaries(number[block[kept]], docs[kept], int(big.sum()), end, term, gain, size)
    summary_end = np.concatenate([[0], s_end])[np.cumsum(big)]
    return [doc_ids, *map(planes, (end, _steps(term, end), gain, np.array(terms), ends, docs, summary_end,
                                    _steps(s_term.astype(np.int64), s_end), s_gain))]


def build(fwd: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int, block_docs: int = BLOCK_DOCS,
          folder: str | None = None) -> DataFrame:
    """Write the index of a forward table; the manifest has one row per file.

    A task writes its slices, one after the other, to an Arrow stream of its own
    name below the shared folder; a task that is lost or run twice leaves at
    most a file that no manifest names.
    """
    spark = fwd.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/cathlake-lexical-{uuid.uuid4().hex}"

    def made(rows):
        doc_ids, terms, tfs, n = zip(*rows, strict=True)
        end = np.cumsum([len(t) // 4 for t in terms])
        tf = np.frombuffer(b"".join(tfs), "<u4").astype(np.int64)
        m = np.array([50 + 50 * x * n_docs // n_terms for x in n], np.int64)
        gain = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, np.diff(end, prepend=0)))
        term = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
        row = build_slice(list(doc_ids), end, term, gain, weight, block_docs)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, INDEX, strict=True)], schema=INDEX)

    def cut(batches: Iterator[pa.RecordBatch]):
        """Rows of documents with terms, in runs of ``SLICE_POSTINGS``."""
        rows, held = [], 0
        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("doc_id", "terms", "tfs", "n")], strict=True):
                if row[1]:
                    rows.append(row)
                    held += len(row[1]) // 4
                    if held >= SLICE_POSTINGS:
                        yield rows
                        rows, held = [], 0
        if rows:
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, n_slices, n = TaskContext.get().partitionId(), None, 0, 0
        name = f"{folder}/part-{part:08d}-{uuid.uuid4().hex}.arrows"
        for rows in cut(batches):
            if writer is None:
                fs, at = file_system(name)
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(at)
                writer = pa.ipc.new_stream(out, INDEX, options=pa.ipc.IpcWriteOptions(compression="lz4"))
            writer.write_batch(made(rows))
            n_slices, n = n_slices + 1, n + len(rows)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([n_slices]), pa.array([n])],
                                             [c.split()[0] for c in MANIFEST.split(", ")])

    ship(spark)
    with arrow_batches(spark):
        return materialize(fwd.select("doc_id", "n", "terms", "tfs").mapInArrow(run, MANIFEST), "lexical-manifest")


# --- search ---------------------------------------------------------------

class Slice:
    """A slice of the index, ready for queries."""

    def __init__(self, row: list):
        self.doc_ids = row[0]
        (self.end, self.term, self.gain, self.block_term, self.block_end, self.block_docs, self.summary_end, self.s_term,
         self.s_gain) = (unplanes(x) for x in row[1:])
        self.end, self.block_end, self.summary_end = (x.astype(np.int64) for x in (self.end, self.block_end, self.summary_end))
        self.term, self.s_term = _unsteps(self.term, self.end), _unsteps(self.s_term, self.summary_end)
        self.start = np.concatenate([[0], self.end[:-1]])
        self.lens = self.end - self.start
        self.block_start = np.concatenate([[0], self.block_end[:-1]])
        self.summary_start = np.concatenate([[0], self.summary_end[:-1]])
        # Smaller of equal scores: documents without id, then by id.
        self.place = np.array([np.iinfo(np.int64).min if d is None else d for d in self.doc_ids], np.int64)

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores; ``weight`` is that of the query's terms and 0 elsewhere."""
        return _dots(self.term, self.gain, self.start, self.lens, docs, weight)

    def blocks(self, terms: np.ndarray) -> np.ndarray:
        """Blocks of the lists of a query's terms."""
        a, b = np.searchsorted(self.block_term, terms), np.searchsorted(self.block_term, terms, "right")
        return gather(np.arange(len(self.block_term)), a, b - a, np.arange(len(a)))[0]

    def docs_of(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.block_docs, self.block_start, self.block_end - self.block_start, blocks)

    def bounds(self, blocks: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Highest score that a document of each block may have."""
        lens = self.summary_end - self.summary_start
        out = _dots(self.s_term, self.s_gain, self.summary_start, lens, blocks, weight)
        small = np.flatnonzero(lens[blocks] == 0)
        if len(small):
            docs, ends = self.docs_of(blocks[small])
            out[small] = np.maximum.reduceat(self.scores(docs, weight), np.concatenate([[0], ends[:-1]]))
        return out


def _dots(term, gain, start, lens, rows, weight) -> np.ndarray:
    """Weighted sums of the rows' gains."""
    out = np.zeros(len(rows), np.int64)
    full = np.flatnonzero(lens[rows])
    if len(full):
        t, ends = gather(term, start, lens, rows[full])
        out[full] = np.add.reduceat(weight[t] * gather(gain, start, lens, rows[full])[0], np.concatenate([[0], ends[:-1]]))
    return out


class Best:
    """The k best (score, place, doc_id) seen of each query, and a floor under its k-th score."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floor, self.k, self.held = floors.copy(), k, [[] for _ in floors]

    def add(self, q: int, scores: np.ndarray, places: np.ndarray):
        good = scores >= self.floor[q]
        if good.any():
            held = self.held[q] + list(zip((-scores[good]).tolist(), places[good].tolist(), strict=True))
            self.held[q] = sorted(held)[:self.k]
            if len(self.held[q]) == self.k:
                self.floor[q] = max(self.floor[q], -self.held[q][-1][0])


def search_slice(s: Slice, queries: list[np.ndarray], weight: np.ndarray, best: Best, seeds_only: bool) -> int:
    """Add a slice's documents to ``best``; the number of documents scored."""
    own, scored = np.zeros(len(weight), np.int64), 0
    for q, terms in enumerate(queries):
        blocks = s.blocks(terms)
        if not len(blocks):
            continue
        own[terms] = weight[terms]
        bounds = s.bounds(blocks, own)
        order = np.argsort(-bounds, kind="stable")[:1 if seeds_only else None]
        seen = np.zeros(len(s.doc_ids), bool)
        at, step = 0, 1
        while at < len(order) and bounds[order[at]] >= best.floor[q]:
            part = order[at:at + step]
            part = part[bounds[part] >= best.floor[q]]
            docs = np.unique(s.docs_of(blocks[part])[0])
            docs = docs[~seen[docs]]
            seen[docs] = True
            best.add(q, s.scores(docs, own), s.place[docs])
            scored += len(docs)
            at, step = at + step, 2 * step
        own[terms] = 0
    return scored


def search(index: DataFrame, queries: list[np.ndarray], weight: np.ndarray, k: int = K) -> DataFrame:
    """The k best documents of each query: query (place in the list), rank, doc_id, score."""
    none = np.iinfo(np.int64).min
    best_first = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())

    def found(floors: np.ndarray, seeds_only: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(floors, k)
            for path in (p for b in batches for p in b.column(0).to_pylist()):
                fs, at = file_system(path)
                with fs.open_input_stream(at) as f, pa.ipc.open_stream(f) as stream:
                    for s in stream:
                        search_slice(Slice([c[0].as_py() for c in s.columns]), queries, weight, best, seeds_only)
            rows = [(q, None if p == none else p, -s) for q, held in enumerate(best.held) for s, p in held]
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                             ["query", "doc_id", "score"])

        files = index.select("path", "part").repartitionByRange(n_files, "part").select("path")
        return files.mapInArrow(run, "query int, doc_id long, score long") \
                    .withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    ship(index.sparkSession)
    n_files = max(1, index.count())
    floors = np.ones(len(queries), np.int64)  # scores above 0 only
    for r in found(floors, True).where(F.col("rank") == k).select("query", "score").collect():
        floors[r["query"]] = max(1, r["score"])
    return found(floors, False).select("query", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(terms_of(t))) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    ship(spark)
    asked = items.select("item_id", whole_text(F.col("text")).alias("text"))
    asked = asked.mapInArrow(tokens, f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<binary>")
    asked = materialize(dense_ids(asked.where(F.size("terms") > 0), ["item_id", "terms"], "number"), "lexical-queries")
    out = None
    for first in range(0, asked.count(), QUERY_BLOCK):
        block = asked.where(F.col("number").between(first, first + QUERY_BLOCK - 1))
        rows = block.orderBy("number").select("terms").collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
        queries = [np.array([vocabulary[bytes(t)] for t in r.terms], np.int64) for r in rows]
        fwd = forward(docs, vocabulary)
        weight, n_docs, n_terms = weights(fwd, len(vocabulary))
        found = search(build(fwd, weight, n_docs, n_terms, block_docs), queries, weight, k)
        names = block.select((F.col("number") - first).cast("int").alias("query"), "item_id")
        part = found.join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    kind = items.schema["item_id"].dataType.simpleString()
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
