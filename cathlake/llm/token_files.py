"""Token-id files, coded by an adaptive context-mixing range coder.

``write`` tokenises whole texts, appends the end id to each document and
writes the ids, in ascending order of doc_id and text hash, as files of independent
blocks (``rangecoder``); ``read`` gives the documents back from the files.

Documents are range-partitioned on their order, so a file holds one range and
files follow each other by ``part``. A text of any length runs on through as
many blocks as it needs; a document is listed in the block in which it
begins. A task writes a file under a name of its own and reports it as a row
of the manifest, so a task that is lost or run twice leaves at most a file
that no manifest names. ``read`` checks each block before and after decoding
and raises on a damaged one.

Files go to a folder that all executors share, through ``pyarrow.fs`` (local,
HDFS, S3 or GCS URIs).

Defined results: a null or empty text is a document of the end id alone;
documents without id come first; equal rows are written one by one, in a row;
of the caller's columns only doc_id and text are read, so others cannot
clash; an empty table gives an empty manifest and reads as no rows. Ids must
lie below 65 536 (``rangecoder.ALPHABET``), else the write fails.
"""

from __future__ import annotations

import uuid
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cathlake.session import checkpoint_dir

from .common import file_system, materialize, ship, whole_text
from .packing import VOCABULARY, _encoder, encode_words
from .rangecoder import ALPHABET, BLOCK, CRC, HEADER, MAGIC, VERSION, decode_ids, encode_ids
from .tokens import loaded, slices

END_ID = 2
MANIFEST = "part int, path string, n_docs long, n_tokens long, n_blocks long, n_bytes long"


# --- blocks ---------------------------------------------------------------

def pack_block(ids: np.ndarray, docs: list[tuple[int | None, int]], alphabet: int) -> bytes:
    """One block: its ids and the (doc_id, length) of documents that begin in it."""
    ids = np.ascontiguousarray(ids, "<u4")
    lens, words = encode_ids(ids, alphabet)
    rest = b"".join([np.array([d is not None for d, _ in docs], np.uint8).tobytes(),
                     np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([n for _, n in docs], "<i8").tobytes(),
                     lens.tobytes(), words.tobytes()])
    head = HEADER.pack(MAGIC, VERSION, 0, alphabet, len(ids), len(docs), len(lens), len(words), zlib.crc32(ids.tobytes()))
    return head + CRC.pack(zlib.crc32(rest, zlib.crc32(head))) + rest


def blocks(read, name: str) -> Iterator[tuple[np.ndarray, list[tuple[int | None, int]]]]:
    """Ids and begun documents of each block; ``read(n)`` gives the next n bytes."""
    k = 0
    while head := read(HEADER.size + CRC.size):
        where = f"block {k} of {name}"
        if len(head) < HEADER.size + CRC.size:
            raise ValueError(f"{where}: damaged, cut off")
        head, tail = head[:HEADER.size], head[HEADER.size:]
        magic, version, _, alphabet, n, n_docs, lanes, n_words, ids_crc = HEADER.unpack(head)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{where}: damaged, or not a block of version {VERSION}")
        rest = read(17 * n_docs + 2 * lanes + 2 * n_words)
        if zlib.crc32(rest, zlib.crc32(head)) != CRC.unpack(tail)[0]:
            raise ValueError(f"{where}: damaged")
        known = np.frombuffer(rest, np.uint8, n_docs).astype(bool).tolist()
        doc_ids = np.frombuffer(rest, "<i8", n_docs, n_docs).tolist()
        lengths = np.frombuffer(rest, "<i8", n_docs, 9 * n_docs).tolist()
        ids = decode_ids(n, alphabet, np.frombuffer(rest, "<u2", lanes, 17 * n_docs),
                         np.frombuffer(rest, "<u2", n_words, 17 * n_docs + 2 * lanes)).astype("<u4")
        if zlib.crc32(ids.tobytes()) != ids_crc:
            raise ValueError(f"{where}: decoded to other ids")
        yield ids, [(d if f else None, m) for f, d, m in zip(known, doc_ids, lengths, strict=True)]
        k += 1


class BlockWriter:
    """Cuts a stream of documents into blocks; ``sink`` takes their bytes."""

    def __init__(self, sink, alphabet: int, block: int = BLOCK):
        self.sink, self.alphabet, self.block = sink, alphabet, block
        self.parts, self.held, self.begun, self.at = [], 0, deque(), 0
        self.n_docs = self.n_tokens = self.n_blocks = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: np.ndarray):
        self.begun.append((self.at + self.held, doc_id, len(ids)))
        self.parts.append(ids)
        self.held += len(ids)
        self.n_docs += 1
        self.n_tokens += len(ids)
        if self.held >= self.block:
            self._put(False)

    def close(self):
        self._put(True)

    def _put(self, last: bool):
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, "<u4")
        s = 0
        while s < len(ids) and (last or len(ids) - s >= self.block):
            part = ids[s:s + self.block]
            s += len(part)
            docs = []
            while self.begun and self.begun[0][0] < self.at + s:
                docs.append(self.begun.popleft()[1:])
            data = pack_block(part, docs, self.alphabet)
            self.sink(data)
            self.n_blocks += 1
            self.n_bytes += len(data)
        self.at += s
        self.parts, self.held = [ids[s:].copy()], len(ids) - s


def documents(found: Iterator[tuple[np.ndarray, list]], keep_ids: bool) -> Iterator[list[tuple]]:
    """Per block, the documents that end in it: doc_id, first id, length, CRC-32 and, on demand, ids."""
    open_docs: deque = deque()
    at = done = crc = 0  # ids of ended documents; ids and CRC so far of the one at the front
    parts: list[bytes] = []
    for ids, begun in found:
        open_docs.extend(begun)
        s, out = 0, []
        while open_docs:
            doc_id, n = open_docs[0]
            take = min(n - done, len(ids) - s)
            raw = ids[s:s + take].tobytes()
            crc, done, s = zlib.crc32(raw, crc), done + take, s + take
            if keep_ids:
                parts.append(raw)
            if done < n:
                break
            out.append((doc_id, at, n, crc, b"".join(parts)) if keep_ids else (doc_id, at, n, crc))
            open_docs.popleft()
            at, done, crc, parts = at + n, 0, 0, []
        yield out
    if open_docs:
        raise ValueError("a document goes on beyond the last block")


# --- files ----------------------------------------------------------------

def write(docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID,
          block: int = BLOCK) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text); the manifest has one row per file."""
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/cathlake-token-files-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = whole_text(F.col("text"))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                     F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("uid"))
    order = [F.col("doc_id").asc_nulls_first(), "key", "uid"]  # the row number parts equal rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, writer = TaskContext.get().partitionId(), None, None
        name = f"{folder}/part-{part:08d}-{uuid.uuid4().hex}.cmrc"
        end = np.array([end_id], "<u4")
        for b in batches:
            for at, texts in slices(b.column(1)):
                coded = encode_words(texts, path)
                if out is None:
                    fs, at_fs = file_system(name)
                    fs.create_dir(at_fs.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(at_fs)
                    alphabet = max(loaded("words", path, _encoder).tokenizer.get_vocab_size(), end_id + 1)
                    if alphabet > ALPHABET:
                        raise ValueError(f"ids beyond {ALPHABET}")
                    writer = BlockWriter(out.write, alphabet, block)
                for doc_id, ids in zip(b.column(0).slice(at, len(texts)).to_pylist(), coded, strict=True):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if out is not None:
            writer.close()
            out.close()
            row = [part, name, writer.n_docs, writer.n_tokens, writer.n_blocks, writer.n_bytes]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                             [c.split()[0] for c in MANIFEST.split(", ")])

    ship(spark)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("key", "uid")
    return materialize(ranged.mapInArrow(run, MANIFEST), "token-manifest")


def read(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """The documents of the manifest's files: doc_id, start (ids of all documents
    before), n_tokens, ids_crc32 and, on demand, ids (binary, little-endian
    unsigned 32-bit)."""
    # One row per file: prefix sums over them are bounded by the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids
    kinds = [pa.int64()] * 4 + [pa.binary()] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                fs, at_fs = file_system(path)
                with fs.open_input_stream(at_fs) as f:
                    for rows in documents(blocks(f.read, path), ids):
                        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
                        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
                        arrays[1] = pa.array([s + before for s in cols[1]], pa.int64())
                        yield pa.RecordBatch.from_arrays(arrays, names)

    ship(manifest.sparkSession)
    n = max(1, manifest.count())
    return files.repartitionByRange(n, "part").mapInArrow(run, schema)
