"""Substring dedup: paragraphs by MinHash banding, passages inside them by windows.

Units of a text, in words ``[^\\x20\\x09-\\x0D]+``:

* paragraphs: lines of at least ``MIN_PARAGRAPH`` words. Equal paragraphs are
  one node. Their five-word shingles give a MinHash signature; ``tune_bands``
  picks the bands for the wanted recall. Paragraphs that collide in a band are
  first compared with the shortest of the band's bucket, its head. Members of a
  head that are then still apart are joined on their differences to it
  (``difference_pairs``), so no link between members is lost, and variants
  with edits of their own give no pairs.
  Exact Jaccard of 0.8 or more on the texts links; linked paragraphs form
  components.
* passages: a repeated passage may begin and end inside paragraphs. Windows of
  ``WINDOW`` words start at winnowed places (the smallest hash among any
  ``SPREAD`` neighbours), so every passage of ``WINDOW + SPREAD - 1`` = 51 words
  or more that two texts share gives both at least one equal window. Equal
  windows are exact copies, for which one band with one row has full recall.
  Such a passage reaches at most ``SPREAD - 1`` words beyond its first and last
  window; the words beside the outer windows are compared with those of the
  first document that holds the window, so all its words count.

The first unit of a component or window, by document key, stays; later ones
in other documents are removed. Documents that share units are clustered by
connected components.

Defined results: a null text is the empty text; repeats inside one document
are left; rows with equal doc_id and text are one document; texts without
units give no row; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.operators.skew import join_back

from .common import field, materialize, packed, release, row_key, ship, whole_text
from .components import components
from .minhash import SHINGLE, THRESHOLD, difference_pairs, jaccard, mix, shingle_set
from .pii import WORD
from .tokens import slices

MIN_PARAGRAPH = 25
WINDOW, SPREAD = 36, 16
RECALL = 0.995
LINE = "\x01"  # stands for a line break among the words
U = np.uint64
BASE = 0x9E3779B97F4A7C15
GRAM = 3


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 48) -> tuple[int, int]:
    """(bands, rows): of the layouts with at most ``most`` hashes and the wanted
    recall at the threshold, the one with the fewest bands that still keeps
    pairs at half the threshold to a few per cent."""
    fits = [(b, r) for r in range(1, most + 1) for b in range(1, most // r + 1)
            if 1 - (1 - threshold ** r) ** b >= recall]
    quiet = [(b, r) for b, r in fits if 1 - (1 - (threshold / 2) ** r) ** b <= 0.5]
    return min(quiet or fits)


BANDS, ROWS = tune_bands()


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash, line of its text and place in its text of every word."""
    texts = pc.replace_substring(texts, LINE, "\x02")  # so that only line breaks become LINE
    split = pc.ascii_split_whitespace(pc.replace_substring(texts, "\n", f" {LINE} "))
    flat = split.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    if not len(flat):
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U), none, none
    enc = flat.dictionary_encode()
    words = enc.dictionary.to_numpy(zero_copy_only=False)
    idx = enc.indices.to_numpy()
    kinds = np.ones(len(words), np.int8)
    for w, k in ((LINE, 2), ("", 0)):
        kinds[pc.equal(enc.dictionary, w).to_numpy(zero_copy_only=False)] = k
    kind = kinds[idx]
    breaks = kind == 2
    n = np.bincount(row[breaks], minlength=len(texts))
    line = np.cumsum(breaks) - (np.cumsum(n) - n)[row]
    keep = kind == 1
    row, line, idx = row[keep], line[keep], idx[keep]
    h = mix(pd.util.hash_array(words, categorize=False))[idx]
    n = np.bincount(row, minlength=len(texts))
    return row, h, line, np.arange(len(row)) - (np.cumsum(n) - n)[row]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(n + 1, BASE, U), np.full(n + 1, inverse, U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


class Hashed:
    """Polynomial hashes of runs of words."""

    def __init__(self, h: np.ndarray):
        self.up, self.down = _powers(len(h))
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(h * self.up[:-1], dtype=U)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def windows(row: np.ndarray, place: np.ndarray, run: Hashed, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat start, hash) of the winnowed windows."""
    n = np.bincount(row, minlength=rows)
    total = len(row)
    none = np.zeros(0, np.int64), np.zeros(0, U)
    if total < WINDOW + SPREAD - 1:
        return none
    gram = np.full(total, np.iinfo(U).max, U)
    at = np.arange(total - GRAM + 1)
    gram[at] = run.of(at, at + GRAM)
    # The first smallest of 2, 4, ... SPREAD neighbours.
    least, at, width = gram, np.arange(total), 1
    while width < SPREAD:
        later = least[width:] < least[:-width]
        at = np.where(later, at[width:], at[:-width])
        least = np.where(later, least[width:], least[:-width])
        width *= 2
    starts = np.unique(at[place[:len(at)] + SPREAD - 1 + WINDOW <= n[row[:len(at)]]])
    return (starts, run.of(starts, starts + WINDOW)) if len(starts) else none


def paragraphs(row: np.ndarray, line: np.ndarray, run: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat start, flat end, hash) of the lines that are long enough."""
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, U)
    cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (line[1:] != line[:-1])]))
    end = np.append(cut[1:], len(row))
    big = end - cut >= MIN_PARAGRAPH
    return cut[big], end[big], run.of(cut[big], end[big])


def _mix_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    """``mix`` without new arrays."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        np.right_shift(x, U(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor != 1:
            np.multiply(x, U(factor), out=x)


def band_hashes(start: np.ndarray, end: np.ndarray, run: Hashed) -> np.ndarray:
    """(paragraphs, BANDS) hashes of MinHash rows over five-word shingles."""
    n = end - start - SHINGLE + 1
    first = np.cumsum(n) - n
    at = np.repeat(start - first, n) + np.arange(n.sum())
    h = run.of(at, at + SHINGLE)
    each, shifted = np.empty_like(h), np.empty_like(h)
    out = np.empty((len(start), BANDS), U)
    for b in range(BANDS):
        x = np.full(len(start), b + 1, U)
        for c in range(ROWS):
            seed = mix(np.array([b * ROWS + c + 1], U) * U(BASE))[0]
            np.bitwise_xor(h, seed, out=each)
            _mix_in_place(each, shifted)
            x = mix(x * U(BASE) + np.minimum.reduceat(each, first)) if len(start) else x
        out[:, b] = x
    return out.view(np.int64)


FEATURES = ("uid long, hash array<long>, at array<int>, par array<long>, par_at array<int>, par_n array<int>, "
            "par_line array<int>, bands array<long>")


def _lists(of: np.ndarray, rows: int, values: np.ndarray, width: int = 1) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]) * width
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values))


def features(src: DataFrame) -> DataFrame:
    """Windows and paragraphs of (uid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in slices(b.column(1)):
                row, h, line, place = _words(part)
                hashed, n = Hashed(h), len(part)
                w, wh = windows(row, place, hashed, n)
                s, e, ph = paragraphs(row, line, hashed)
                bands = band_hashes(s, e, hashed)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, n), _lists(row[w], n, wh.view(np.int64)), _lists(row[w], n, place[w].astype(np.int32)),
                    _lists(row[s], n, ph.view(np.int64)), _lists(row[s], n, place[s].astype(np.int32)),
                    _lists(row[s], n, (e - s).astype(np.int32)), _lists(row[s], n, line[s].astype(np.int32)),
                    _lists(row[s], n, bands.ravel(), BANDS)],
                    ["uid", "hash", "at", "par", "par_at", "par_n", "par_line", "bands"])

    return src.mapInArrow(run, FEATURES)


def paragraph_texts(wanted: DataFrame, feats: DataFrame, src: DataFrame) -> DataFrame:
    """(par, text) of the paragraphs ``wanted`` (par), read from the first document that holds each."""
    held = feats.select("uid", F.explode(F.arrays_zip("par", "par_line")).alias("x")).select("x.par", "uid", F.col("x.par_line").alias("line"))
    held = join_back(held, wanted, ["par"], "left_semi").groupBy("par").agg(F.min(F.struct("uid", "line")).alias("m"))
    # A document's list is bounded by its own lines.
    lines = held.groupBy("m.uid").agg(F.collect_list(F.struct("par", "m.line")).alias("w"))
    # The same plan at every size: a small input would broadcast the lists and hide the shuffle.
    both = src.join(lines.hint("merge"), "uid").select(F.split("text", "\n", -1).alias("lines"), "w")
    found = both.select(F.explode(F.transform("w", lambda x: F.struct(
        x["par"].alias("par"), F.get("lines", x["line"]).alias("text")))).alias("x")).select("x.par", "x.text")
    return found.groupBy("par").agg(F.any_value("text").alias("text"))  # rows with equal doc_id and text share a uid


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    left = texts.select(F.col("par").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("par").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for b in batches:
            keep = []
            for i, (ta, tb) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                if tb != last:
                    last, own = tb, shingle_set(tb)
                if jaccard(shingle_set(ta), own) >= threshold:
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def paragraph_components(feats: DataFrame, src: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, comp) of linked paragraphs that are not equal."""
    par = feats.where(F.size("par") > 0).select(F.explode(F.arrays_zip("par", "par_n", F.transform(
        F.sequence(F.lit(0), F.size("par") - 1), lambda i: F.slice("bands", i * BANDS + 1, F.lit(BANDS))).alias("b"))).alias("x")) \
        .select(F.col("x.par").alias("par"), F.col("x.par_n").alias("n"), F.explode(F.col("x.b")).alias("bucket"))
    heads = par.groupBy("bucket").agg(F.min(F.struct("n", "par")).alias("head"), F.max(F.struct("n", "par")).alias("last"))
    heads = heads.where("head != last").select("bucket", F.col("head.par").alias("head"))
    members = materialize(join_back(par.select("bucket", "par"), heads, ["bucket"]).distinct(), "members")
    wanted = materialize(members.select("par").distinct(), "wanted")
    texts = materialize(paragraph_texts(wanted, feats, src), "texts")
    star = members.where("par != head").select(F.col("par").alias("a"), F.col("head").alias("b")).distinct()
    found = materialize(_verified(star, texts, threshold), "links")
    comp = materialize(components(found), "components")
    # Members that share a head and are not yet all in one component; each has been compared with the head itself.
    held = members.where("par != head").select("par", "head").distinct().join(comp.withColumnRenamed("node", "par"), "par", "left")
    held = materialize(held.select(F.col("par").alias("th"), F.col("head").alias("hth"), F.coalesce("comp", "par").alias("comp")), "held")
    apart = held.groupBy("hth").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    rest = join_back(held, apart.select("hth"), ["hth"], "left_semi")
    pairs = difference_pairs(rest, texts.withColumnRenamed("par", "th"), threshold)
    more = materialize(_verified(pairs, texts, threshold), "links")
    release(members, wanted, texts, comp, held)
    return components(found.unionByName(more))


def extended(hits: DataFrame, src: DataFrame) -> DataFrame:
    """(uid, start, end, first) of longer runs around the windows ``hits`` that other documents hold too.

    A window needs no run on a side where another hit of the same fate covers
    all words that the run could add, in every document that holds the window.
    """
    # A document's list is bounded by its own windows.
    each = hits.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("start", "hash", (F.col("first") == F.col("uid")).alias("own")))).alias("w"))

    def open_on(right: bool):
        side = 1 if right else -1

        def alone(x, i):
            others = F.slice("w", i + 1 if right else F.greatest(i - WINDOW + 1, F.lit(1)), F.lit(WINDOW + 1))
            return ~F.exists(others, lambda y: (y["own"] == x["own"]) & ((y["start"] - x["start"]) * side).between(SPREAD - 1, WINDOW))
        return F.transform(F.filter("w", alone), lambda x: F.struct(x["hash"].alias("hash"), F.lit(right).alias("right")))

    marks = each.select(F.explode(F.concat(open_on(False), open_on(True))).alias("x")).groupBy("x.hash").agg(
        F.max(~F.col("x.right")).alias("left"), F.max("x.right").alias("right"))
    marks = materialize(marks, "outer")
    outer = join_back(hits, marks, ["hash"])
    each = outer.groupBy("uid").agg(F.collect_list(F.when(F.col("left"), F.col("start"))).alias("lefts"),
                                    F.collect_list(F.when(F.col("right"), F.col("start"))).alias("rights"))
    sides = materialize(src.join(each, "uid").select("uid", "text", "lefts", "rights").mapInArrow(_beside, SIDES), "sides")
    out = shared_extensions(sides)
    release(marks, sides)
    start = F.when(F.col("right"), F.col("fixed")).otherwise(F.col("fixed") - WINDOW - F.col("more"))
    end = F.when(F.col("right"), F.col("fixed") + WINDOW + F.col("more")).otherwise(F.col("fixed"))
    return out.select("uid", start.alias("start"), end.alias("end"), "first")


SIDES = "uid long, fixed int, right boolean, runs array<long>"


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of each window with one to ``SPREAD - 1`` words beyond it, for (uid, text, lefts, rights)."""
    for b in batches:
        for at, part in slices(b.column(1)):
            row, h, _, _ = _words(part)
            run = Hashed(h)
            n = np.bincount(row, minlength=len(part))
            base = np.cumsum(n) - n
            for side in (2, 3):
                lists, right = b.column(side).slice(at, len(part)), side == 3
                of = np.repeat(np.arange(len(part)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                w = lists.flatten().to_numpy().astype(np.int64)
                room = np.minimum(n[of] - w - WINDOW if right else w, SPREAD - 1)
                of, w, room = of[room > 0], w[room > 0], room[room > 0]
                step = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + 1
                edge = np.repeat(base[of] + w, room)
                runs = run.of(edge, edge + WINDOW + step) if right else run.of(edge - step, edge + WINDOW)
                off = np.concatenate([[0], np.cumsum(room)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.column(0).to_numpy()[at + of]), pa.array((w if right else w + WINDOW).astype(np.int32)),
                     pa.array(np.full(len(w), right)), pa.ListArray.from_arrays(pa.array(off), pa.array(runs.view(np.int64)))],
                    ["uid", "fixed", "right", "runs"])


def shared_extensions(sides: DataFrame) -> DataFrame:
    """(uid, right, fixed, more, first): how far a window's run of words goes on in other documents too.

    Copies of a window that go on alike are one path. A run (the window with
    1, 2, ... of the words beside it) is repeated if the paths that hold it
    come from two documents or more, and the first of these documents keeps
    it. For each copy the longest repeated run counts and, if the copy's own
    document is the first of that one, also the longest run that another
    document holds earlier.
    """
    path = F.element_at("runs", -1)
    paths = sides.groupBy("right", "runs").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    paths = materialize(paths.withColumn("path", path), "paths")
    each = paths.select("right", "path", "lo", "hi", F.posexplode("runs").alias("more", "run"))
    held = each.groupBy("right", "run").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first != last").drop("last")
    # A path's list is bounded by ``SPREAD - 1``; a longer run has no earlier first document.
    steps = join_back(each.drop("lo", "hi"), held, ["right", "run"]).groupBy("right", "path", "first").agg((F.max("more") + 1).alias("more")) \
        .groupBy("right", "path").agg(F.array_sort(F.collect_list(F.struct("more", "first"))).alias("steps"))
    steps = materialize(steps, "steps")
    rows = join_back(sides.select("uid", "right", "fixed", path.alias("path")), steps, ["right", "path"])
    last = F.element_at("steps", -1)
    other = F.get(F.filter("steps", lambda x: x["first"] != F.col("uid")), F.size(F.filter("steps", lambda x: x["first"] != F.col("uid"))) - 1)
    out = rows.select("uid", "right", "fixed", F.explode(F.array_compact(F.array_distinct(F.array(last, other)))).alias("x")) \
        .select("uid", "right", "fixed", "x.more", "x.first")
    out = materialize(out, "extensions")
    release(paths, steps)
    return out


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(uid, first, spans): per document with repeats the smallest uid it shares
    a unit with, and its repeated word ranges (start, end, first uid)."""
    whole = whole_text(F.col(f"`{text}`"))
    src = docs.select(F.xxhash64(row_key(F.col(f"`{doc_id}`").cast("long"), whole)).alias("uid"), whole.alias("text"))
    feats = materialize(features(src), "features")

    win = feats.select("uid", F.explode("hash").alias("hash"))
    twice = win.groupBy("hash").agg(F.min("uid").alias("first"), F.max("uid").alias("last")).where("first != last")
    twice = twice.select("hash", "first")
    at = feats.select("uid", F.explode(F.arrays_zip("hash", "at")).alias("x")).select("uid", "x.hash", "x.at")
    hits = join_back(at, twice, ["hash"]).select("uid", F.col("at").alias("start"), (F.col("at") + WINDOW).alias("end"), "first", "hash")
    hits = materialize(hits, "windows")
    hits = hits.drop("hash").unionByName(extended(hits, src))

    par = feats.select("uid", F.explode(F.arrays_zip("par", "par_at", "par_n")).alias("x")) \
        .select("uid", F.col("x.par").alias("node"), F.col("x.par_at").alias("start"), (F.col("x.par_at") + F.col("x.par_n")).alias("end"))
    comp = materialize(paragraph_components(feats, src, threshold), "comp")
    par = materialize(par.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "par")
    shared = par.groupBy("comp").agg(F.min("uid").alias("first"), F.max("uid").alias("last")).where("first != last")
    shared = shared.select("comp", "first")
    hits = hits.unionByName(join_back(par, shared, ["comp"]).select("uid", "start", "end", "first"))
    # A document's list is bounded by its own units.
    return materialize(hits.groupBy("uid").agg(
        F.min("first").alias("first"), F.collect_set("first").alias("firsts"),
        F.sort_array(F.collect_list(F.struct("start", "end", "first"))).alias("spans")), "hits")


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points where the words of all texts start and end, and where each text's first word is among them."""
    texts = texts.cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    edge = off[off < len(data)]
    before[edge] = False
    after[edge[edge > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off)
    if len(data) and data.max() >= 0x80:
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        start, end, off = points[start], points[end], points[off]
    base = np.repeat(off[:-1], np.diff(first))
    return start - base, end - base, first


def _union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges that cover the given ones, which are sorted by start."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[cut], reach[np.append(cut[1:], len(start)) - 1]


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document with repeated passages: doc_id, cluster (smallest doc_id
    of the documents it is linked to), repeated and removed words, and the
    repeated ranges as code points start:end."""
    ship(docs.sparkSession)
    hits = repeated(docs, text, doc_id)
    edges = hits.select(F.col("uid").alias("a"), F.explode("firsts").alias("b"))
    comp = materialize(components(edges), "clusters")
    whole = whole_text(F.col(f"`{text}`"))
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole.alias("text")) \
        .withColumn("uid", F.xxhash64(row_key(F.col("doc_id"), F.col("text"))))
    rows = src.join(hits.select("uid", "spans").join(comp.withColumnRenamed("node", "uid"), "uid", "left"), "uid") \
        .select("doc_id", "text", "uid", "spans", "comp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every, gone, told = [], [], []
            for at, part in slices(b.column(1)):
                start, end, word = word_spans(part)
                lists = b.column(3).slice(at, len(part))
                off, flat = lists.offsets.to_numpy(), lists.values
                s, e, f = (flat.field(i).to_numpy() for i in range(3))
                for i, uid in enumerate(b.column(2).slice(at, len(part)).to_numpy()):
                    own = slice(off[i], off[i + 1])
                    x, y = _union(s[own], e[own])
                    every.append(int((y - x).sum()))
                    told.append(",".join(f"{p}:{q}" for p, q in zip(start[word[i] + x].tolist(), end[word[i] + y - 1].tolist(), strict=True)))
                    x, y = _union(s[own][f[own] != uid], e[own][f[own] != uid])
                    gone.append(int((y - x).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(4), pa.array(every, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(told, pa.string())],
                                             ["doc_id", "comp", "repeated_words", "removed_words", "spans"])

    out = materialize(rows.mapInArrow(run, "doc_id long, comp long, repeated_words long, removed_words long, spans string"), "rows")
    heads = out.groupBy("comp").agg(F.min("doc_id").alias("cluster"))
    return join_back(out, heads, ["comp"], "left").select("doc_id", "cluster", "repeated_words", "removed_words", "spans")


def cut(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the repeated passages whose first copy is in another document."""
    ship(docs.sparkSession)
    hits = repeated(docs, text, doc_id).select(F.col("uid").alias("_cl_uid"), F.col("spans").alias("_cl_spans"))
    rows = packed(docs).withColumn("_cl_uid", F.xxhash64(row_key(field(doc_id).cast("long"), whole_text(field(text))))) \
        .join(hits, "_cl_uid", "left")
    n, at = len(docs.columns), docs.columns.index(text)
    flat = rows.select(*[field(c).alias(f"_cl_c{i}") for i, c in enumerate(docs.columns)], "_cl_uid", "_cl_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for t, uid, spans in zip(*(b.column(i).to_pylist() for i in (at, n, n + 1)), strict=True):
                if spans:
                    words, parts, last = [m.span() for m in WORD.finditer(t)], [], 0
                    removed = [(x["start"], x["end"]) for x in spans if x["first"] != uid]
                    for x, y in zip(*_union(*np.array(removed, np.int64).reshape(-1, 2).T), strict=True):
                        parts.append(t[last:words[x][0]])
                        last = words[y - 1][1]
                    t = "".join([*parts, t[last:]])
                new.append(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, pa.string()) if i == at else b.column(i) for i in range(n)], b.schema.names[:n])

    return flat.mapInArrow(run, flat.drop("_cl_uid", "_cl_spans").schema).toDF(*docs.columns)
