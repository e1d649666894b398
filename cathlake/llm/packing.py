"""Best-fit packing by linear grouping.

1. Tokenise: every document becomes pieces of at most ``capacity`` tokens.
2. Round: large pieces (over ``capacity / 8``), ranked from long to short, are
   cut into ``GROUPS`` groups of equal cardinality; a group counts with its
   longest length.
3. Configurations: with at most ``GROUPS`` sizes, repeatedly take the largest
   size left, fill the rest of a sequence as full as the sizes allow, and use
   that configuration as often as the counts permit.
4. Substitute: the pieces of a group, by rank, take the places of its size;
   they are no longer than it, so they fit.
5. Best fit: small pieces, from long to short, go to the fullest sequences
   that still hold them; what is left opens new sequences.

Plans are made from histograms of lengths and of free space, which have at
most ``capacity`` + 1 entries at any corpus size; a plan is a list of rank
ranges. Pieces get their global rank from a range sort, so no task holds
more than one partition of them. Only the histograms reach the driver.

Defined results: a null or empty text is one piece holding only the end id;
equal rows are packed one by one; an empty table packs to nothing.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cathlake.operators.numbering import global_positions

from .common import materialize, row_key, schema_plus, ship, whole_text
from .tokens import SegmentEncoder, loaded, slices

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
WORD_END = "</w>"  # closes the last token of a word
GROUPS = 256
LARGE = 8  # a piece is large above capacity / LARGE

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _cl_key binary"


# --- tokens ---------------------------------------------------------------

def _encoder(path: str) -> SegmentEncoder:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)  # strings of special tokens become those tokens
    ends = np.zeros(t.get_vocab_size(), bool)
    ends[[i for token, i in t.get_vocab().items() if token.endswith(WORD_END)]] = True
    return SegmentEncoder(t, ends)


def encode_words(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Ids of each text. The tokenizer drops white space and folds case, so
    white-space words are independent; case is folded and punctuation after a
    letter set apart beforehand only where that can change neither how characters compose nor
    what reads as a special token."""
    enc = loaded("words", path, _encoder)
    texts = pc.fill_null(texts, "")
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), "(\\p{L})([.,!?;:])", "\\1 \\2")
    texts = pc.if_else(pc.match_substring_regex(texts, "\\p{M}|<\\|"), texts, plain)
    ids, ends, _ = enc.lists(pc.ascii_split_whitespace(texts))
    return np.split(ids, ends[:-1])


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: position, length and CRC of the ids."""
    path = path or public_tokenizers.path(VOCABULARY)
    text = whole_text(F.col("text"))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), text).alias("_cl_key"),
                     text.alias("_cl_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], "<u4")
        for b in batches:
            for at, texts in slices(b.column(2)):
                rows, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encode_words(texts, path)):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s:s + capacity]
                        rows.append(at + i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), b.column(1).take(take)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "_cl_key"])

    ship(docs.sparkSession)
    return df.mapInArrow(run, PIECES)


# --- plans over histograms ------------------------------------------------

def group_sizes(counts: dict[int, int], groups: int = GROUPS) -> tuple[list[int], int]:
    """Rounded size of each equal-cardinality group, from long to short, and the cardinality."""
    n = sum(counts.values())
    each = max(1, -(-n // groups))
    sizes, seen = [], 0
    for length in sorted(counts, reverse=True):
        while len(sizes) * each < seen + counts[length]:
            sizes.append(length)  # the group's first piece is its longest
        seen += counts[length]
    return sizes, each


def _fill(sizes: list[int], left: list[int], room: int) -> dict[int, int]:
    """Multiset of sizes (index -> copies) of the largest total at most ``room``."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for j, size in enumerate(sizes):
        for _ in range(min(left[j], room // size)):
            grown = (reach | reach << size) & mask
            if grown == reach:
                break
            steps.append((j, reach))
            reach = grown
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for j, before in reversed(steps):
        if total and not before >> total & 1:
            used[j] = used.get(j, 0) + 1
            total -= sizes[j]
    return used


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(size index -> copies, times used) until every size is used up. Sizes fall."""
    left, out = list(counts), []
    for j, size in enumerate(sizes):
        while left[j]:
            left[j] -= 1
            config = _fill(sizes[j:], left[j:], capacity - size)
            left[j] += 1
            config = {j + k: c for k, c in config.items()}
            config[j] = config.get(j, 0) + 1
            times = min(left[k] // c for k, c in config.items())
            for k, c in config.items():
                left[k] -= times * c
            out.append((config, times))
    return out


def plan_large(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rank ranges of the large pieces (first rank, first sequence) and the number of sequences."""
    if not counts:
        return np.zeros((0, 2), np.int64), 0
    sizes, each = group_sizes(counts)
    n = sum(counts.values())
    in_group = [min(each, n - g * each) for g in range(len(sizes))]
    merged: dict[int, list[int]] = {}  # groups of one size act as one
    for g, s in enumerate(sizes):
        merged.setdefault(s, []).append(g)
    order = sorted(merged, reverse=True)
    total = [sum(in_group[g] for g in merged[s]) for s in order]
    first = [merged[s][0] * each for s in order]  # rank of a size's next piece
    rows, seq = [], 0
    for config, times in configurations(order, total, capacity):
        for j, copies in sorted(config.items()):
            for _ in range(copies):
                rows.append((first[j], seq))
                first[j] += times
        seq += times
    return np.array(sorted(rows), np.int64), seq


def plan_small(counts: dict[int, int], free: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best fit on histograms. ``free``: sequences by free space, which are
    ranked from little to much. Returns rank ranges of the small pieces (first
    rank, first sequence rank) and the number of new sequences, ranked last."""
    bins: dict[int, list[tuple[int, int]]] = {}  # free space -> [first rank, count]
    at = 0
    for space in sorted(free):
        bins.setdefault(space, []).append((at, free[space]))
        at += free[space]
    old, rows, rank = at, [], 0
    spaces = sorted(bins)

    def add(space: int, run: tuple[int, int]):
        if space not in bins:
            bisect.insort(spaces, space)
            bins[space] = []
        bins[space].append(run)

    rest = sum(s * n for s, n in counts.items())
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            i = bisect.bisect_left(spaces, size)
            if i == len(spaces):  # open as many sequences as the rest needs at least
                new = max(1, min(-(-rest // capacity), n))
                add(capacity, (at, new))
                at += new
                continue
            space = spaces[i]
            first, m = bins[space].pop()
            if not bins[space]:
                del bins[space]
                spaces.pop(i)
            used = min(m, n)
            rows.append((rank, first))
            rank, n, rest = rank + used, n - used, rest - used * size
            if used < m:
                add(space, (first + used, m - used))
            add(space - size, (first, used))
    return np.array(rows, np.int64).reshape(-1, 2), at - old


def _lookup(df: DataFrame, rank: str, plan: np.ndarray, name: str) -> DataFrame:
    """``df`` plus ``name``: the sequence that the plan gives to a rank. The plan
    is a few thousand ranges at any corpus size."""
    firsts, seqs = plan[:, 0].copy(), plan[:, 1].copy()
    at = df.columns.index(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = b.column(at).to_numpy()
            k = np.searchsorted(firsts, r, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seqs[k] + r - firsts[k])], [*b.schema.names, name])

    return df.mapInArrow(run, schema_plus(df, (name, "long")))


def _histogram(df: DataFrame, col: str) -> dict[int, int]:
    """Counts by a value of 0 to ``capacity``: bounded whatever the corpus."""
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


# --- the operator ---------------------------------------------------------

def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize(pieces(docs, path, capacity), "pieces")
    cut = cut.withColumn("_cl_uid", F.monotonically_increasing_id())  # parts equal rows in the range sort
    counts = _histogram(cut, "length")
    large = {s: n for s, n in counts.items() if s > capacity // LARGE}
    small = {s: n for s, n in counts.items() if s <= capacity // LARGE}
    plan, n_seq = plan_large(large, capacity)

    ranked = global_positions(cut, [F.col("length").desc(), F.col("_cl_key"), F.col("piece"), F.col("_cl_uid")], "_cl_rank")
    n_large = sum(large.values())
    placed = ranked.where(F.col("_cl_rank") < n_large)
    placed = materialize(_lookup(placed, "_cl_rank", plan, "_cl_seq"), "placed") if n_large else None

    # Sequences by free space; a sequence's place in that order is its final id.
    if placed is not None:
        free = placed.groupBy("_cl_seq").agg((F.lit(capacity) - F.sum("length")).alias("_cl_free"))
        free = materialize(global_positions(free, ["_cl_free", "_cl_seq"], "sequence_id"), "free")
        placed = placed.join(free.select("_cl_seq", "sequence_id"), "_cl_seq").drop("_cl_seq")
        room = _histogram(free, "_cl_free")
    else:
        room = {}
    fill, _ = plan_small(small, room, capacity)
    rest = ranked.where(F.col("_cl_rank") >= n_large).withColumn("_cl_small", F.col("_cl_rank") - n_large)
    rest = _lookup(rest, "_cl_small", fill, "sequence_id").drop("_cl_small") if len(fill) else None
    parts = [p for p in (placed, rest) if p is not None]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "_cl_rank"]
    if not parts:
        return ranked.withColumn("sequence_id", F.lit(0).cast("long")).select(
            *cols[:-1], F.lit(0).cast("long").alias("offset"))
    both = parts[0].select(*cols)
    for p in parts[1:]:
        both = both.unionByName(p.select(*cols))
    # A sequence holds at most ``capacity`` pieces, so its window is bounded.
    before = Window.partitionBy("sequence_id").orderBy("_cl_rank").rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_cl_rank")
