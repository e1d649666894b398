"""Alignment of two tokenizers over whole texts, and the id pairs it links.

A is a byte-level BPE (``tokenizers``), B a SentencePiece model. Both read a
space and the text. Byte offsets where a token of A and one of B both end cut
a text into groups; an A and a B token whose byte ranges overlap are linked.
As boundaries inside a group never coincide, each stretch between neighbouring
boundaries of either side is one link.

Fast path: a vocabulary-length array gives for each A id the B id of the same
bytes. A group of one A and one B token that agrees with it is counted in a
vocabulary-length vector; only links of other groups enter the pair shuffle,
as distinct pairs of a slice of documents with their counts.

1. ``slices_of``: one row per slice of about ``SLICE_BYTES`` of text, with the
   documents' figures, the A ids of their one-to-one groups, the slice's
   distinct irregular pairs with counts, and each irregular link as an index
   into these. Written once.
2. ``pair_counts``: vectors and slice pairs, added up by pair.
3. ``report``: one-to-one groups look their count up in a vector; each slice
   gets the counts of its own distinct pairs back and adds them up by
   document. Slices bound every group of rows; the driver sees vectors of the
   two vocabularies' lengths only.

Defined results: a text that is null or empty, or whose joined A or B bytes
differ from space and text (any text with U+2581, which B reads as a space),
has no tokens: zeros and the empty string. Strings of special tokens are
ordinary text. Equal rows are aligned one by one and all count. Of the
caller's columns only doc_id and text are read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.operators.skew import join_back

from .bpe import _byte_table, _encoder, encode_slice
from .common import arrow_batches, gather, materialize, planes, ship, unplanes, whole_text
from .tokens import SegmentEncoder, loaded, slices

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
CUT = "\x01"
SPACE = "▁"  # stands for a space in pieces of B
SLICE_BYTES = 512 << 10   # text of a slice; a longer text is a slice of its own
CACHE_SEGMENTS = 120_000  # of each side, as a worker holds two caches
DIGEST_TOKENS = 200_000  # tokens spelled out at a time

DOCS = "slice long, i int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"

_Encoded = namedtuple("_Encoded", "ids")


# --- tokens of B ----------------------------------------------------------

class _Pieces:
    """A SentencePiece model with the interface that ``SegmentEncoder`` uses."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False):
        return [_Encoded(x) for x in self.model.encode(texts, num_threads=1)]


def _piece_encoder(path: str) -> SegmentEncoder:
    pieces = _Pieces(path)
    enc = SegmentEncoder(pieces)
    known = [pieces.model.id_to_piece(i) for i in range(pieces.model.get_piece_size())]
    # Where no piece goes on past a space, texts may be cut before each run of spaces.
    enc.cuttable = not any(SPACE in p.lstrip(SPACE) for p in known)
    enc.lone_space = np.array([pieces.model.piece_to_id(SPACE)], "<u4").tobytes()
    return enc


def encode_pieces(texts: pa.Array, path: str) -> list[np.ndarray]:
    """B's ids of each text; B itself puts the space before a text."""
    enc = loaded("pieces", path, _piece_encoder)
    whole = pc.or_(pc.match_substring(texts, CUT), pc.match_substring(texts, SPACE)).to_numpy(zero_copy_only=False)
    if not enc.cuttable:
        whole[:] = True
    # A segment leaves out its first space: B puts it back.
    cut = pc.replace_substring_regex(pc.if_else(pa.array(whole), "", texts), "([^ ]) ", "\\1" + CUT)
    enc.cache[""] = enc.lone_space
    ids, ends, _ = enc.lists(pc.split_pattern(cut, CUT))
    out = np.split(ids, ends[:-1])
    for i in np.flatnonzero(whole | (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0)):
        out[i] = enc.whole(texts[int(i)].as_py())
    return out


def _piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat bytes, starts and lengths by id of B."""
    model = loaded("pieces", path, _piece_encoder).tokenizer.model
    parts = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else
             model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(model.get_piece_size())]
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens, lens


def same_bytes(paths: tuple[str, str]) -> np.ndarray:
    """For each A id the B id of the same bytes, or -1; a piece goes before a byte token."""
    (fa, sa, la), (fb, sb, lb) = loaded("bytes", paths[0], _byte_table), loaded("piece bytes", paths[1], _piece_bytes)
    model = loaded("pieces", paths[1], _piece_encoder).tokenizer.model
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(sb)), key=lambda i: not model.is_byte(i)):
        if not (model.is_control(i) or model.is_unknown(i)):
            by_bytes[fb[sb[i]:sb[i] + lb[i]].tobytes()] = i
    return np.array([by_bytes.get(fa[s:s + n].tobytes(), -1) for s, n in zip(sa, la, strict=True)], np.int64)


# --- alignment of a slice -------------------------------------------------

class Aligned:
    """Tokens, groups and links of a slice of texts, in flat arrays.

    ``a``, ``b``: ids; ``a_end``, ``b_end``, ``group_end``: by document, the
    tokens and groups up to its end; ``a_upto``, ``b_upto``: by group, the
    tokens up to its end; ``link_a``, ``link_b``, ``link_group``, ``link_doc``:
    by link, the places of its tokens, its group and its document.
    """

    def __init__(self, texts: pa.Array, paths: tuple[str, str]):
        for kind, path, make in (("byte-level", paths[0], _encoder), ("pieces", paths[1], _piece_encoder)):
            loaded(kind, path, make).cache_segments = CACHE_SEGMENTS
        spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, "")
        ta, tb = encode_slice(spaced, paths[0]), encode_pieces(texts, paths[1])
        (fa, sa, la), (fb, sb, lb) = loaded("bytes", paths[0], _byte_table), loaded("piece bytes", paths[1], _piece_bytes)
        none = np.zeros(0, "<u4")
        for i, text in enumerate(spaced.to_pylist()):
            raw = text.encode()
            if len(raw) == 1 or gather(fa, sa, la, ta[i])[0].tobytes() != raw or gather(fb, sb, lb, tb[i])[0].tobytes() != raw:
                ta[i] = tb[i] = none
        self.a, self.b = np.concatenate(ta).astype(np.int64), np.concatenate(tb).astype(np.int64)
        self.a_end, self.b_end = np.cumsum([len(x) for x in ta]), np.cumsum([len(x) for x in tb])
        ends_a, ends_b = np.cumsum(la[self.a]), np.cumsum(lb[self.b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        in_a, in_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        in_a[ends_a], in_b[ends_b] = True, True
        cut = np.flatnonzero(in_a | in_b)
        at_a, at_b = in_a[cut], in_b[cut]
        both = at_a & at_b
        upto_a, upto_b, upto_g = np.cumsum(at_a), np.cumsum(at_b), np.cumsum(both)
        self.link_a, self.link_b, self.link_group = upto_a - at_a, upto_b - at_b, upto_g - both
        closing = np.flatnonzero(both)
        self.a_upto, self.b_upto = upto_a[closing], upto_b[closing]
        self.group_end = np.searchsorted(self.a_upto, self.a_end, "right")  # groups up to a document's end
        self.link_end = np.concatenate([[0], closing + 1])[self.group_end]
        self.link_doc = np.repeat(np.arange(len(ta)), np.diff(self.link_end, prepend=0))

    def regular(self, same: np.ndarray) -> np.ndarray:
        """By group: one A and one B token, as the identity map has them."""
        one = (np.diff(self.a_upto, prepend=0) == 1) & (np.diff(self.b_upto, prepend=0) == 1)
        one[one] = same[self.a[self.a_upto[one] - 1]] == self.b[self.b_upto[one] - 1]
        return one

    def digests(self, spelled: tuple[np.ndarray, np.ndarray, np.ndarray], n_a_ids: int) -> list[str]:
        """SHA-256 of each document's groups, spelled out."""
        na, nb = len(self.a), len(self.b)
        a_groups, b_groups = np.diff(self.a_upto, prepend=0), np.diff(self.b_upto, prepend=0)
        tokens = np.empty(na + nb, np.int64)  # A then B tokens of each group; even: a comma follows
        last = np.zeros(na, np.int64)
        last[self.a_upto - 1] = 1
        tokens[np.arange(na) + np.repeat(self.b_upto - b_groups, a_groups)] = 2 * self.a + last
        last = np.zeros(nb, np.int64)
        last[self.b_upto - 1] = 1
        tokens[np.arange(nb) + np.repeat(self.a_upto, b_groups)] = 2 * (self.b + n_a_ids) + last
        out, s = [], 0
        for e in (self.a_end + self.b_end).tolist():
            if s == e:
                out.append("")
                continue
            h = hashlib.sha256()
            for k in range(s, e, DIGEST_TOKENS):
                raw = gather(*spelled, tokens[k:min(e, k + DIGEST_TOKENS)])[0].tobytes()
                h.update(raw if k + DIGEST_TOKENS < e else raw[:-1])  # no separator after the last token
            out.append(h.hexdigest())
            s = e
        return out


def _spelled(paths: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal ids with what follows them: a comma, or after a group's last A token a bar, B token a semicolon."""
    n_a, n_b = len(loaded("bytes", paths[0], _byte_table)[1]), len(loaded("piece bytes", paths[1], _piece_bytes)[1])
    parts = [f"{i}{c}".encode() for n, close in ((n_a, "|"), (n_b, ";")) for i in range(n) for c in (",", close)]
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens, lens


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The alignment itself: doc_id and ``groups``, an array of (a, b), the ids of both sides in order."""
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1), SLICE_BYTES):
                x = Aligned(texts, paths)
                sides = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]), pa.int32()), pa.array(ids, pa.int32()))
                         for upto, ids in ((x.a_upto, x.a), (x.b_upto, x.b))]
                out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], x.group_end]), pa.int32()),
                                               pa.StructArray.from_arrays(sides, ["a", "b"]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), out], ["doc_id", "groups"])

    ship(docs.sparkSession)
    return _input(docs).mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


# --- slices ---------------------------------------------------------------

SLICES = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, single binary, single_end binary, pairs binary, pair_counts binary, "
          "links binary, link_end binary")


def slices_of(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The aligned slices, written below the shared checkpoint folder."""
    paths = _paths(path_a, path_b)
    names = [c.split()[0] for c in SLICES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        same, spelled = loaded("same", paths, same_bytes), loaded("spelled", paths, _spelled)
        k = TaskContext.get().partitionId() << 32
        for b in batches:
            for at, texts in slices(b.column(1), SLICE_BYTES):
                x = Aligned(texts, paths)
                one = x.regular(same)
                single = x.a[x.a_upto[one] - 1]
                odd = ~one[x.link_group]
                pairs, index, n = np.unique((x.a[x.link_a[odd]] << 32) | x.b[x.link_b[odd]], return_inverse=True, return_counts=True)
                by_count = np.argsort(-n, kind="stable")  # frequent pairs get small numbers
                place = np.empty(len(by_count), np.int64)
                place[by_count] = np.arange(len(by_count))
                per_doc = [np.diff(e, prepend=0) for e in (x.a_end, x.b_end, x.group_end, x.link_end)]
                row = [k, b.column(0).slice(at, len(texts)).to_pylist(), *[c.tolist() for c in per_doc],
                       x.digests(spelled, len(same)), planes(single),
                       np.concatenate([[0], np.cumsum(one)])[x.group_end].astype("<i8").tobytes(),
                       pairs[by_count].astype("<i8").tobytes(), n[by_count].astype("<i8").tobytes(), planes(place[index]),
                       np.cumsum(np.bincount(x.link_doc[odd], minlength=len(texts))).astype("<i8").tobytes()]
                kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)
                k += 1

    ship(docs.sparkSession)
    with arrow_batches(docs.sparkSession):
        return materialize(_input(docs).mapInArrow(run, SLICES), "aligned")


def _slice_pairs(aligned: DataFrame) -> DataFrame:
    """The distinct irregular pairs of each slice: slice, i, pair (a << 32 | b), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, pairs, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
                pairs, n = np.frombuffer(pairs, "<i8"), np.frombuffer(n, "<i8")
                for at in range(0, len(pairs), 50_000):
                    p = pairs[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(p), s)), pa.array(np.arange(at, at + len(p), dtype=np.int32)), pa.array(p),
                         pa.array(n[at:at + 50_000])], ["slice", "i", "pair", "n"])

    return aligned.select("slice", "pairs", "pair_counts").mapInArrow(run, "slice long, i int, pair long, n long")


def pair_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Links of each id pair over all slices: pair (a << 32 | b), n; written below the shared checkpoint folder."""
    paths = _paths(path_a, path_b)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = loaded("same", paths, same_bytes)
        count = np.zeros(len(same), np.int64)
        for b in batches:
            for single in b.column(0).to_pylist():
                count += np.bincount(unplanes(single), minlength=len(same))
        a = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array((a << 32) | same[a]), pa.array(count[a])], ["pair", "n"])

    ship(aligned.sparkSession)
    both = aligned.select("single").mapInArrow(vectors, "pair long, n long") \
                  .unionByName(_slice_pairs(aligned).select("pair", "n"))
    with arrow_batches(aligned.sparkSession):
        return materialize(both.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    paths = _paths(path_a, path_b)
    aligned = slices_of(docs, *paths)
    counts = pair_counts(aligned, *paths)
    # Vectors of the vocabularies' lengths: the highest count of each B id, and the counts of the identity map's pairs.
    same, n_b = same_bytes(paths), len(loaded("piece bytes", paths[1], _piece_bytes)[1])
    highest, identity = np.zeros(n_b, np.int64), np.zeros(len(same), np.int64)
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    for r in counts.groupBy(b.alias("b")).agg(F.max("n").alias("n")).collect():
        highest[r.b] = r.n
    known = np.flatnonzero(same >= 0)
    mapped = spark.createDataFrame([(int(i), int(same[i])) for i in known], "a long, b long") if len(known) else None
    if mapped is not None:
        keys = mapped.select((F.shiftleft("a", 32)).bitwiseOR(F.col("b")).alias("pair"))
        for r in counts.join(keys, "pair", "left_semi").select(a.alias("a"), "n").collect():
            identity[r.a] = r.n
    best = (identity == highest[same]) & (identity > 0)

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with the sums over their one-to-one groups."""
        for batch in batches:
            for r in batch.to_pylist():
                ids, end = unplanes(r["single"]), np.frombuffer(r["single_end"], "<i8")
                n = len(end)
                cols = [pa.array(np.full(n, r["slice"])), pa.array(np.arange(n, dtype=np.int32)),
                        *[pa.array(r[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                        pa.array(r["groups_sha256"], pa.string()),
                        *[pa.array(np.diff(np.concatenate([[0], np.cumsum(v)])[end], prepend=0))
                          for v in (best[ids].astype(np.int64), identity[ids])]]
                yield pa.RecordBatch.from_arrays(cols, [*[c.split()[0] for c in DOCS.split(", ")], "n_best", "count_sum"])

    def irregular(left: pa.Table, right: pa.Table) -> pa.Table:
        """Sums over a slice's irregular links by document. Counts come for the slice's own pairs."""
        out = []
        for r in left.to_pylist():
            pairs = np.frombuffer(r["pairs"], "<i8")
            n = np.zeros(len(pairs), np.int64)
            n[right.column("i").to_numpy()] = right.column("total").to_numpy()
            top = (n == highest[pairs & ((1 << 32) - 1)]).astype(np.int64)
            links, end = unplanes(r["links"]), np.frombuffer(r["link_end"], "<i8")
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[links])])[end], prepend=0) for v in (top, n)]
            i = np.flatnonzero(np.diff(end, prepend=0))
            out.append(pa.table([pa.array(np.full(len(i), r["slice"])), pa.array(i.astype(np.int32)), *[pa.array(s[i]) for s in sums]],
                                ["slice", "i", "n_best", "count_sum"]))
        return pa.concat_tables(out)

    ship(spark)
    rows = aligned.select("slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "single", "single_end")
    rows = rows.mapInArrow(singles, DOCS + ", n_best long, count_sum long")
    answers = join_back(_slice_pairs(aligned).select("slice", "i", "pair"), counts.withColumnRenamed("n", "total"), ["pair"])
    odd = aligned.where(F.octet_length("links") > 0).select("slice", "pairs", "links", "link_end")
    sums = odd.groupBy("slice").cogroup(answers.select("slice", "i", "total").groupBy("slice")) \
              .applyInArrow(irregular, "slice long, i int, n_best long, count_sum long")
    figures = ["n_best", "count_sum"]
    blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in ("slice", "i", *figures)]
    both = rows.unionByName(sums.select("slice", "i", *figures, *blank))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    out = both.groupBy("slice", "i").agg(*[F.max(c).alias(c) for c in kept], *[F.sum(c).alias(c) for c in figures])
    with arrow_batches(spark):
        return materialize(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment")
