"""Near-duplicate documents by ProbMinHash.

A document is a weighted set of five-word shingles, once with unit weights and
once with 1 + ln c for a shingle that occurs c times. Every shingle is a
Poisson process whose rate is its weight; each arrival falls into one of
``SLOTS`` slots and a slot keeps the shingle that arrives first. A shingle
stops as soon as its next arrival comes after the latest first arrival of all
slots. Two documents agree in a slot with their probability Jaccard
similarity, which for unit weights is the set Jaccard that defines a link, so
that repeats inside a text cost no recall.

Bands of ``ROWS`` slots of either signature make buckets (a text without
repeats has the same buckets twice and is put into them once). Equal texts are one node from the start.
In each bucket all nodes are first compared with the bucket's shortest node, its
head, then with the shortest one outside the head's component; such pairs must
agree in enough one-bit slots of the unit signature (``MAX_APART`` of 320 may
differ: 4.5 standard deviations beyond the expectation at 0.8) before their
texts are fetched. Members that are then still in different components are
joined on their differences to the head: two texts that the head does not
connect can only be alike by sharing such differences (``difference_pairs``),
so copies never expand into all pairs and no link between different texts of a
bucket is lost. A link is verified on the texts: exact Jaccard of five-word
shingle sets of 0.8 or more. Classes are the connected components of the links.

Recall of the banding: at least 1 - (1 - J^8)^40, 0.9993 at a set Jaccard J = 0.8.

Defined results: a null text is the empty text; a text of one to four words is
one shingle; texts without words are near-duplicates only of equal texts; a
class is named by its smallest doc_id (null if it has none); an empty table
gives an empty table.
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

from .common import ROW, field, materialize, packed, row_key, ship, whole_text
from .components import components
from .tokens import slices

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 8
SLOTS = BANDS * ROWS
MAX_APART = 56
BIT_WORDS = [f"bits{i}" for i in range(SLOTS // 64)]
SLICE_ARRIVALS = 2  # arrivals drawn per slot and round for short documents

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, hash, occurrences."""
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    row = row[full]
    enc = flat.filter(pa.array(full)).dictionary_encode()
    if not len(row):
        return row, np.zeros(0, U), row
    words = pd.util.hash_array(np.array(enc.dictionary.to_pylist(), object), categorize=False)[enc.indices.to_numpy()]
    n = np.bincount(row, minlength=len(texts))
    first = np.cumsum(n) - n
    place = np.arange(len(row)) - first[row]
    at = np.flatnonzero((place + size <= n[row]) | (place == 0))
    h = np.zeros(len(at), U)
    for k in range(size):
        i = at + k
        here = place[at] + k < n[row[at]]
        h = h * U(0x9E3779B97F4A7C15) + mix(np.where(here, words[np.minimum(i, len(words) - 1)], U(0)) + U(k + 1))
    h = mix(h)
    r = row[at]
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]))
    return r[new], h[new], np.diff(np.concatenate([new, [len(r)]]))


def signatures(row: np.ndarray, h: np.ndarray, weight: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """(rows, slots) shingle hashes: each slot's first arrival."""
    best = np.full(rows * slots, np.inf)
    sig = np.zeros(rows * slots, U)
    latest = np.full(rows, np.inf)
    each = np.bincount(row, minlength=rows)
    draws = np.clip(SLICE_ARRIVALS * slots // np.maximum(each, 1), 1, 128)  # arrivals per shingle and round
    t, k = np.zeros(len(row)), np.zeros(len(row), np.int64)
    while len(row):
        d = draws[row]
        end = np.cumsum(d)
        of = np.repeat(np.arange(len(row)), d)
        step = np.arange(len(of)) - (end - d)[of]
        seed = mix(h[of] + (k[of] + step + 1).astype(U) * U(0x9E3779B97F4A7C15))
        u = ((seed >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        gap = np.cumsum(-np.log(u) / weight[of])
        start = np.concatenate([[0.0], gap])[end - d]
        arrive = t[of] + gap - start[of]
        live = arrive < latest[row[of]]
        slot = row[of[live]] * slots + (mix(seed[live]) % U(slots)).astype(np.int64)
        at = arrive[live]
        np.minimum.at(best, slot, at)
        won = best[slot] == at
        sig[slot[won]] = h[of[live][won]]
        touched = np.unique(row)
        latest[touched] = best.reshape(rows, slots)[touched].max(axis=1)
        t = arrive[end - 1]
        k = k + d
        go = t < latest[row]
        row, h, weight, t, k = row[go], h[go], weight[go], t[go], k[go]
    return sig.reshape(rows, slots)


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    out = np.empty((len(sig), bands), U)
    width = sig.shape[1] // bands
    for b in range(bands):
        x = np.full(len(sig), b + 1, U)
        for c in range(width):
            x = mix(x * U(0x9E3779B97F4A7C15) + sig[:, b * width + c])
        out[:, b] = x
    return out.view(np.int64)


def buckets(sig: np.ndarray, row: np.ndarray, h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, 2 BANDS) hashes of the unit signature ``sig`` and of the weighted one, and which of them to use."""
    again = np.zeros(len(sig), bool)
    again[row[count > 1]] = True  # all other rows have equal signatures
    some = again[row]
    of = np.cumsum(again) - 1
    unit = band_hashes(sig)
    weighted = unit.copy()
    weighted[again] = band_hashes(signatures(of[row[some]], h[some], 1 + np.log(count[some]), int(again.sum())))
    has = np.bincount(row, minlength=len(sig)) > 0
    use = np.concatenate([np.ones(unit.shape, bool), weighted != unit], axis=1) & has[:, None]
    return np.concatenate([unit, weighted], axis=1), use


def one_bits(sig: np.ndarray) -> np.ndarray:
    """One bit of every slot, 64 to a word; the slot counts, so that the few shingles of a short text give independent bits."""
    bit = mix(sig + np.arange(1, sig.shape[1] + 1).astype(U) * U(0x9E3779B97F4A7C15)) & U(1)
    return (bit.reshape(len(sig), -1, 64) << np.arange(64, dtype=U)).sum(axis=2, dtype=U).view(np.int64)


def sketch(texts: DataFrame) -> DataFrame:
    """``texts`` (key, th, doc_id, text) with n (distinct shingles), bands and bits instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in slices(b.column(3)):
                row, h, c = shingles(part)
                n = np.bincount(row, minlength=len(part))
                sig = signatures(row, h, np.ones(len(h)), len(part))
                bits = one_bits(sig)
                bands, use = buckets(sig, row, h, c)
                off = np.concatenate([[0], np.cumsum(use.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i).slice(at, len(part)) for i in range(3)], pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(bands[use])),
                     *[pa.array(bits[:, i]) for i in range(bits.shape[1])]],
                    ["key", "th", "doc_id", "n", "bands", *BIT_WORDS])

    return texts.mapInArrow(run, "key binary, th binary, doc_id long, n int, bands array<bigint>, "
                            + ", ".join(f"{w} long" for w in BIT_WORDS))


def shingle_set(text: str, size: int = SHINGLE) -> set:
    """Five-word shingles of a text as a set."""
    w = text.encode().split()
    return set(zip(*[w[k:] for k in range(size)], strict=False)) if len(w) >= size else {tuple(w)} if w else set()


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if both else 0.0


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold, with their similarity."""
    left = texts.select(F.col("th").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("th").alias("b"), F.col("text").alias("tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for b in batches:
            keep, sim = [], []
            for i, (ta, tb) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                if tb != last:
                    last, own = tb, shingle_set(tb)
                j = jaccard(shingle_set(ta), own)
                if j >= threshold:
                    keep.append(i)
                    sim.append(j)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(sim, pa.float64())],
                                             ["a", "b", "similarity"])

    return both.mapInArrow(run, "a binary, b binary, similarity double")


def _likely(threshold: float):
    """Sets of such sizes can reach the threshold."""
    return F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")


def _apart(x: str, y: str):
    """One-bit slots in which two members differ (columns by prefix)."""
    return sum((F.bit_count(F.col(f"{x}{w}").bitwiseXOR(F.col(f"{y}{w}"))) for w in BIT_WORDS), F.lit(0))


def links(nodes: DataFrame, docs_text: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Components (node, comp) of the links between distinct texts.

    ``nodes``: th, n, bands, bits, one row per distinct text; ``docs_text``: th, text, with repeats.
    """
    rows = nodes.select("th", "n", F.explode("bands").alias("bucket"))
    heads = rows.groupBy("bucket").agg(F.min(F.struct("n", "th")).alias("head"), F.count(F.lit(1)).alias("size")) \
        .where(F.col("size") > 1).drop("size")
    members = join_back(rows, heads, ["bucket"]).select(
        "bucket", "th", "n", F.col("head.n").alias("hn"), F.col("head.th").alias("hth"))
    bits = nodes.select("th", *BIT_WORDS)
    members = members.join(bits, "th").join(bits.select(F.col("th").alias("hth"), *[F.col(w).alias(f"h{w}") for w in BIT_WORDS]), "hth")
    members = materialize(members, "members")
    # Texts that some bucket holds together with another, once each.
    wanted = materialize(members.select("th").distinct(), "wanted")
    # The same plan at every size: a small input would broadcast the wanted ones and hide the shuffle.
    texts = docs_text.join(wanted.hint("merge"), "th", "left_semi").groupBy("th").agg(F.any_value("text").alias("text"))
    texts = materialize(texts, "texts")

    star = members.select(F.col("th").alias("a"), F.col("hth").alias("b"), F.col("n").alias("na"), F.col("hn").alias("nb"),
                          _apart("", "h").alias("apart")) \
        .where((F.col("a") != F.col("b")) & _likely(threshold) & (F.col("apart") <= MAX_APART)).select("a", "b").distinct()
    found = materialize(verified(star, texts, threshold), "links")
    comp = materialize(components(found), "components")

    # A second star, to the shortest member outside the first one's component, joins groups of another variant.
    placed = materialize(_placed(members.select("bucket", "th", "n", "hn", "hth", *BIT_WORDS), comp), "placed")
    second = placed.where(F.col("comp") != F.col("hcomp")).groupBy("bucket") \
        .agg(F.min(F.struct("n", "th", *BIT_WORDS)).alias("s"))
    star = join_back(placed, second, ["bucket"]).select(
        F.col("th").alias("a"), F.col("s.th").alias("b"), F.col("n").alias("na"), F.col("s.n").alias("nb"),
        sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"s.{w}"))) for w in BIT_WORDS), F.lit(0)).alias("apart")) \
        .where((F.col("a") != F.col("b")) & _likely(threshold) & (F.col("apart") <= MAX_APART)).select("a", "b").distinct()
    found = materialize(found.unionByName(verified(star, texts, threshold)), "links")
    comp = materialize(components(found), "components")

    # Members that share a head and are not yet all in one component.
    held = materialize(_placed(members.select("th", "hth").distinct(), comp).drop("hcomp"), "held")
    split = held.groupBy("hth").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") != F.col("hi"))
    rest = join_back(held, split.select("hth"), ["hth"], "left_semi")
    return components(found.unionByName(verified(difference_pairs(rest, texts, threshold), texts, threshold)))


def _placed(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` (th, hth, ...) with the components of both."""
    out = rows.join(comp.select(F.col("node").alias("th"), "comp"), "th", "left")
    out = join_back(out, comp.select(F.col("node").alias("hth"), F.col("comp").alias("hcomp")), ["hth"], "left")
    return out.withColumn("comp", F.coalesce("comp", "th")).withColumn("hcomp", F.coalesce("hcomp", "hth"))


def differences(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """head, th, comp, n (shingles) and d: the shingles that only one of the text and its head holds."""
    both = rest.where("th != hth").join(texts, "th").select("th", "hth", "comp", "text") \
        .join(texts.select(F.col("th").alias("hth"), F.col("text").alias("ht")), "hth").select("hth", "th", "comp", "text", "ht")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.zeros(0, U)
        for b in batches:
            heads = b.column(4)
            for at, part in slices(b.column(3)):
                row, h, _ = shingles(part)
                n = np.bincount(row, minlength=len(part))
                end = np.cumsum(n)
                apart = []
                for i in range(len(part)):
                    head = b.column(0)[at + i].as_py()
                    if head != last:
                        last, own = head, shingles(heads.slice(at + i, 1))[1]
                    apart.append(np.setxor1d(h[end[i] - n[i]:end[i]], own, assume_unique=True))
                off = np.concatenate([[0], np.cumsum([len(x) for x in apart])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i).slice(at, len(part)) for i in range(3)], pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(apart).view(np.int64)))],
                    ["head", "th", "comp", "n", "d"])

    kind = rest.schema["th"].dataType.simpleString()
    return both.mapInArrow(run, f"head {kind}, th {kind}, comp {kind}, n int, d array<bigint>")


def difference_pairs(rest: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of texts that share a head, are in different components and may reach the threshold.

    With dx and dy the differences of x and y to their head, x and y differ in
    exactly the shingles that dx and dy do not share, so a link needs
    |dx & dy| >= (|dx| + |dy| - T) / 2 for T = (1 - t) / (1 + t) * (|x| + |y|).
    Differences are ordered from rare to frequent among the texts of the head;
    of the first shingle that both hold, no more than the rest of either can be
    common. Copies of one text with edits of their own share few, frequent
    differences, which come last, so they give no pairs.
    """
    width = (1 - threshold) / (1 + threshold)
    sets = materialize(differences(rest, texts), "differences")
    each = sets.select("head", "th", "comp", "n", F.size("d").alias("m"), F.explode("d").alias("t"))
    often = each.groupBy("head", "t").agg(F.count(F.lit(1)).alias("f"), (F.min("comp") != F.max("comp")).alias("open")) \
        .where("f > 1")
    # A text's list is bounded by its own shingles and its head's.
    listed = join_back(each, often, ["head", "t"]).groupBy("head", "th", "comp", "n", "m") \
        .agg(F.sort_array(F.collect_list(F.struct("f", "t", "open"))).alias("s"))
    # ``rest`` of a place: how many differences from here on can be common.
    place = listed.select("head", "th", "comp", "n", "m", F.size("s").alias("k"), F.posexplode("s").alias("i", "s")) \
        .withColumn("rest", F.col("k") - F.col("i"))
    least = F.col("m") - F.floor(width * (1 + 1 / threshold) * F.col("n") + 1e-6)
    place = materialize(place.where(F.col("s.open") & (F.col("rest") >= least))
                        .select("head", F.col("s.t").alias("t"), "th", "comp", "n", "m", "rest"), "places")
    x = place.select("head", "t", F.col("th").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"),
                     F.col("m").alias("ma"), F.col("rest").alias("ra"))
    y = place.select("head", "t", F.col("th").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"),
                     F.col("m").alias("mb"), F.col("rest").alias("rb"))
    need = F.col("ma") + F.col("mb") - width * (F.col("na") + F.col("nb")) - 1e-6
    return x.join(y, ["head", "t"]).where(
        (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & _likely(threshold)
        & (2 * F.least("ra", "rb") >= need)).select("a", "b").distinct()


def members(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, doc_id and comp (the class, by one of its text hashes) per row."""
    ship(docs.sparkSession)
    whole = whole_text(F.col(f"`{text}`"))
    ids = F.col(f"`{doc_id}`").cast("long")
    src = docs.select(row_key(ids, whole).alias("key"), F.unhex(F.md5(whole)).alias("th"), ids.alias("doc_id"), whole.alias("text"))
    sk = materialize(sketch(src), "sketch")
    nodes = sk.groupBy("th").agg(F.any_value("n").alias("n"), F.any_value("bands").alias("bands"),
                                *[F.any_value(w).alias(w) for w in BIT_WORDS])
    nodes = materialize(nodes, "nodes")
    comp = links(nodes, src.select("th", "text"), threshold)
    comp = materialize(comp.withColumnRenamed("node", "th"), "comp")
    return sk.select("key", "th", "doc_id").join(comp, "th", "left").select(
        "key", "doc_id", F.coalesce("comp", "th").alias("comp"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, doc_id, class_id and ``keep`` (the class's first document) per distinct (doc_id, text)."""
    member = materialize(members(docs, text, doc_id, threshold), "member")
    head = member.groupBy("comp").agg(F.min("doc_id").alias("class_id"),
                                      F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    return join_back(member, head, ["comp"]).select("key", "doc_id", "class_id", (F.col("key") == F.col("first.key")).alias("keep"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with the caller's columns. Of rows that
    share doc_id and text one stays, by the hash of the whole row."""
    kept = classes(docs, text, doc_id, threshold).where("keep").groupBy("key").agg(F.count(F.lit(1)).alias("_cl_n"))
    kept = materialize(kept.withColumnRenamed("key", "_cl_key"), "kept")
    rows = packed(docs).withColumn("_cl_key", row_key(field(doc_id).cast("long"), whole_text(field(text))))
    single = rows.join(kept.where("_cl_n = 1"), "_cl_key").select(ROW)
    repeated = rows.join(kept.where("_cl_n > 1"), "_cl_key").groupBy("_cl_key").agg(
        F.min(F.struct(F.xxhash64(ROW).alias("h"), F.col(ROW).alias("r"))).alias("m")).select(F.col("m.r").alias(ROW))
    return single.unionByName(repeated).select(f"{ROW}.*")
