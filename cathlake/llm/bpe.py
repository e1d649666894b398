"""Byte-level BPE with the tokenizers library over Arrow batches.

``encode`` gives the ids of each whole text as packed little-endian unsigned
32-bit integers, optionally with each token's character offsets; ``decode``
reverses the byte table. A token may hold only a part of a multi-byte
character: decoding joins the bytes of all tokens before any text is read
from them, and the offsets of such a token cover the whole character.

Segments: the split pattern never joins two non-space characters across a
single space, nor an ASCII letter and a following ``.`` or ``,``; texts are
cut there. A text with other white space next to such a space is encoded
whole.

Defined results: a null text is the empty text, which has no ids and decodes
to no bytes. Strings of special tokens are ordinary text. Rows are encoded
one by one, so repeated rows repeat; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, schema_plus, ship, whole_text
from .tokens import SegmentEncoder, loaded, slices

VOCABULARY = "byte_bpe_50k.json"  # the vocabulary of byte_bpe_50k.tiktoken, in the library's own format
CUT = "\x01"


def byte_characters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def _encoder(path: str) -> SegmentEncoder:
    return SegmentEncoder(_tokenizer(path))


def _byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat bytes, starts and lengths by token id."""
    alphabet = byte_characters()
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    parts = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        parts[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens, lens


def encode_slice(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of each text."""
    enc = loaded("byte-level", path, _encoder)
    texts = pc.fill_null(texts, "")
    marked = pc.match_substring(texts, CUT)
    cut = pc.replace_substring(pc.if_else(marked, "", texts), " ", CUT + " ")
    cut = pc.replace_substring_regex(cut, "([A-Za-z])([.,])", "\\1" + CUT + "\\2")
    ids, ends, skip = enc.lists(pc.split_pattern(cut, CUT), lambda s: s[-1:].isspace())
    out = np.split(ids, ends[:-1])
    for i in np.flatnonzero(skip | marked.to_numpy(zero_copy_only=False)):
        out[i] = enc.whole(texts[int(i)].as_py())
    return out


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    flat, starts, lens = loaded("bytes", path, _byte_table)
    return gather(flat, starts, lens, ids)[0].tobytes()


def char_offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token."""
    _, _, lens = loaded("bytes", path, _byte_table)
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
    end = np.cumsum(lens[ids])
    return char[end - lens[ids]], char[end - 1] + 1


def encode(docs: DataFrame, text: str = "text", path: str | None = None, offsets: bool = False,
           decoded: bool = False) -> DataFrame:
    """``docs`` without its text, plus ``ids`` (binary) and, on demand, ``starts`` and
    ``ends``, and ``decoded`` (the bytes that the ids stand for, in the same pass).

    Columns of the caller that bear one of these names are replaced.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    made = ["ids"] + ["starts", "ends"] * offsets + ["decoded"] * decoded
    kept = [c for c in docs.columns if c != text and c not in made]
    # Columns go by position below, so that no name of the caller's can clash.
    df = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], whole_text(F.col(f"`{text}`")).alias("text"))
    kinds = {"ids": "binary", "starts": "array<int>", "ends": "array<int>", "decoded": "binary"}
    schema = schema_plus(docs.select(*[F.col(f"`{c}`") for c in kept]), *[(c, kinds[c]) for c in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(len(kept))):
                ids = encode_slice(texts, path)
                cols = [pa.array([x.tobytes() for x in ids], pa.binary())]
                if offsets:
                    spans = [char_offsets(t, x, path) for t, x in zip(texts.to_pylist(), ids, strict=True)]
                    cols += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                if decoded:
                    cols.append(pa.array([decode_ids(x, path) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(at, len(texts)) for i in range(len(kept))] + cols, kept + made)

    ship(docs.sparkSession)
    return df.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded``: the bytes that the ids stand for (null ids: none)."""
    path = path or public_tokenizers.path(VOCABULARY)
    kept = [c for c in encoded.columns if c != "decoded"]
    df = encoded.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [decode_ids(np.frombuffer(x or b"", "<u4"), path) for x in b.column(kept.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], [*kept, "decoded"])

    ship(encoded.sparkSession)
    return df.mapInArrow(run, schema_plus(df, ("decoded", "binary")))
