"""Exact top-k search by inner product with an M-tree over Parquet.

Inner products become distances: with M the largest squared norm, a stored
vector x is extended by sqrt(M - |x|^2) and a query q by 0, so that
|q' - x'|^2 = |q|^2 + M - 2 q.x, and the highest products are the nearest
neighbours in a metric space.

The tree has three levels of nodes:
* regions: at most ``PIVOTS`` routing vectors, chosen from a sample of at most
  ``SAMPLE`` rows; every row belongs to the region of its nearest pivot;
* nodes: a region's rows in parts of about ``NODE_ROWS`` (a very common vector
  just fills several nodes), one index row each, with covering radius;
* pages of at most ``PAGE`` entries, each with routing vector, covering radius
  and distance to its parent; every entry stores its distance to its page's
  routing vector, and a page keeps its entries in that order.

Search is best first. A query begins in its own node; the k-th score found
there bounds the regions that it still has to see. Within a node, pages come
by their lower bound; |d(q, parent) - d(c, parent)| - radius > bound drops a
page before its distance is computed, and |d(q, c) - d(x, c)| > bound drops
entries before theirs. Bounds carry a margin for rounding, relative to M, and
scores are computed on the integers, so the result is exact: as doubles while M
is below 2^53, which bounds every sum of products, as 64-bit integers beyond.

Defined results: vectors that are null, or hold null or non-finite
components, and rows without vec_id take no part; shorter vectors count as
filled up with zeros; equal vectors are separate candidates, ordered by
vec_id; of rows that share a vec_id each is a candidate, a query only leaves
out its own row; an empty table gives an empty result; a squared
norm of 2^62 or more raises, as its scores need not fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

PIVOTS = 1024
SAMPLE = 16_384
NODE_ROWS = 2048
PAGE = 64
EXACT = 2.0 ** 53  # below this squared norm doubles hold every sum of products
NONE = np.iinfo(np.int64).min + 1  # no score yet, among integer scores (its negative must fit too)
QUERY_BLOCK = 4096  # queries that meet a node at a time
MARGIN = 1e-3       # slack of a bound, in units of the score

QUERY = "uid long, vec_id long, region int, salt int, v array<double>, kth double"
NODE = ("region int, salt int, rows int, radius double, page_center binary, page_radius binary, page_dist binary, "
        "page_start binary, entry_dist binary, vectors binary, vec_ids binary, uids binary")
HIT = "uid long, query_id long, vec_id long, score long, kth double"


def prepared(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id and integer components floor(scale * x) of the vectors that take part."""
    e = F.transform(F.col(f"`{embedding}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    finite = F.forall(F.col(f"`{embedding}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return embeddings.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{embedding}`").isNotNull() & F.coalesce(finite, F.lit(False))) \
        .select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), e.alias("v"))


def _matrix(vs, dim: int) -> np.ndarray:
    out = np.zeros((len(vs), dim))
    for i, v in enumerate(vs):
        out[i, :len(v)] = v
    return out


def _extended(x: np.ndarray, m: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(m - (x * x).sum(axis=1), 0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def choose_pivots(sample: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """Routing vectors spread over the sample (each next one drawn with probability by squared distance)."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return sample
    picked = [int(rng.integers(len(sample)))]
    near = _distances(sample, sample[picked])[:, 0] ** 2
    while len(picked) < min(count, len(sample)) and near.sum() > 0:
        picked.append(int(rng.choice(len(sample), p=near / near.sum())))
        near = np.minimum(near, _distances(sample, sample[picked[-1:]])[:, 0] ** 2)
    return sample[picked]


def build_node(x: np.ndarray, vec_ids: np.ndarray, uids: np.ndarray, center: np.ndarray, m: float) -> dict:
    """Index columns of one node over the integer vectors ``x``."""
    ext = _extended(x, m)
    n = len(x)
    rng = np.random.default_rng(n)
    heads = ext[np.sort(rng.choice(n, max(1, n * 2 // PAGE), replace=False))]
    page = _distances(ext, heads).argmin(axis=1)
    order, starts, centers, radii = [], [], [], []
    for p in range(len(heads)):
        rows = np.flatnonzero(page == p)
        d = _distances(ext[rows], heads[p:p + 1])[:, 0]
        by = np.argsort(d, kind="stable")  # chunks of one page are shells around its routing vector
        for at in range(0, len(rows), PAGE):
            part = by[at:at + PAGE]
            starts.append(len(order))
            order += rows[part].tolist()
            centers.append(p)
            radii.append(d[part].max())
    order = np.array(order)
    ends = np.append(starts[1:], n).astype(np.int64)
    owner = np.repeat(centers, ends - starts)
    entry = np.sqrt(np.maximum(((ext[order] - heads[owner]) ** 2).sum(axis=1), 0))
    c = heads[centers]
    return {"rows": n, "radius": float(_distances(ext, center[None])[:, 0].max()), "page_center": c.tobytes(),
            "page_radius": np.array(radii).tobytes(), "page_dist": _distances(c, center[None])[:, 0].tobytes(),
            "page_start": np.append(starts, n).astype(np.int64).tobytes(), "entry_dist": entry.tobytes(),
            "vectors": x[order].tobytes(), "vec_ids": vec_ids[order].tobytes(), "uids": uids[order].tobytes()}


class Best:
    """The k best (score, vec_id) of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray, wide: bool = False):
        self.none = NONE if wide else -np.inf
        self.score, self.vec = np.full((n, k), self.none), np.full((n, k), np.iinfo(np.int64).max)
        # Scores below it are of no use. It comes as a double, so it is lowered by more than its rounding.
        self.floor = np.maximum(floor - np.abs(floor) * 2.0 ** -50 - 1, float(NONE)).astype(np.int64) if wide else floor

    def kth(self, rows=slice(None)) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def offer(self, rows: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        useful = (score >= self.kth(rows)[:, None]).any(axis=1)
        rows, score = rows[useful], score[useful]
        if not len(rows):
            return
        s = np.hstack([self.score[rows], score])
        v = np.hstack([self.vec[rows], np.broadcast_to(vec, score.shape)])
        order = np.lexsort((v, -s), axis=1)[:, :self.score.shape[1]]
        self.score[rows], self.vec[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(v, order, 1)


def _reach(q2: np.ndarray, m: float, kth: np.ndarray) -> np.ndarray:
    """Distance beyond which no vector scores ``kth`` (less the margin)."""
    slack = max(MARGIN, 1e-12 * m)
    return np.sqrt(np.maximum(q2 + m - 2 * (kth - slack), 0)) + 4e-6 * max(1.0, m ** 0.5)


def search_node(node: pd.Series, center: np.ndarray, q: np.ndarray, uid: np.ndarray, floor: np.ndarray, k: int, m: float,
                counted: dict | None = None) -> Best:
    """Best-first search of one node for many queries, in step: in each round
    every query visits its next page, queries on the same page together."""
    dim = q.shape[1]
    c = np.frombuffer(node.page_center).reshape(-1, dim + 1)
    radius, parent = np.frombuffer(node.page_radius), np.frombuffer(node.page_dist)
    start, entry = np.frombuffer(node.page_start, np.int64), np.frombuffer(node.entry_dist)
    x = np.frombuffer(node.vectors).reshape(-1, dim)
    vec, own = np.frombuffer(node.vec_ids, np.int64), np.frombuffer(node.uids, np.int64)
    wide = m >= EXACT
    best = Best(len(q), k, floor, wide)
    qi, xi = (q.astype(np.int64), x.astype(np.int64)) if wide else (q, x)
    q2 = (q * q).sum(axis=1)
    ext = np.hstack([q, np.zeros((len(q), 1))])
    up = _distances(ext, center[None])
    # Stored parent distances bound a page from below without computing its distance.
    bound = np.abs(up - parent[None, :]) - radius[None, :]
    d = np.full(bound.shape, np.nan)
    may = bound <= _reach(q2, m, best.kth())[:, None]
    cols = np.flatnonzero(may.any(axis=0))
    d[:, cols] = _distances(ext, c[cols])
    bound[:, cols] = np.maximum(bound[:, cols], d[:, cols] - radius[cols])
    order = np.argsort(bound, axis=1, kind="stable")
    alive = np.arange(len(q))
    for step in range(bound.shape[1]):
        page = order[alive, step]
        reach = _reach(q2[alive], m, best.kth(alive))
        go = bound[alive, page] <= reach  # pages come by their bound: a query that fails once is done
        alive, page, reach = alive[go], page[go], reach[go]
        if not len(alive):
            break
        by = np.argsort(page, kind="stable")
        cuts = np.flatnonzero(np.diff(page[by])) + 1
        for g in np.split(by, cuts):
            p, rows = page[g[0]], alive[g]
            a, b = start[p], start[p + 1]
            # Entries lie in order of their stored distance: only a run of them can be near enough.
            dq = d[rows, p]
            lo = a + np.searchsorted(entry[a:b], (dq - reach[g]).min(), "left")
            hi = a + np.searchsorted(entry[a:b], (dq + reach[g]).max(), "right")
            if counted is not None:
                counted["pages"] = counted.get("pages", 0) + len(rows)
                counted["entries"] = counted.get("entries", 0) + len(rows) * int(hi - lo)
            if lo < hi:
                score = qi[rows] @ xi[lo:hi].T
                score[own[None, lo:hi] == uid[rows][:, None]] = best.none
                best.offer(rows, score, vec[lo:hi])
    return best


def _hits(uid: np.ndarray, query_id: np.ndarray, best: Best) -> pd.DataFrame:
    real = best.score > best.none
    r, c = np.nonzero(real)
    return pd.DataFrame({"uid": uid[r], "query_id": query_id[r], "vec_id": best.vec[r, c],
                         "score": best.score[r, c].astype(np.int64), "kth": best.score[r, -1].astype(float)})


def index(rows: DataFrame, pivots: np.ndarray, m: float, dim: int) -> DataFrame:
    """One row per node over ``rows`` (uid, vec_id, v, region, salt)."""

    def build(key, pdf):
        cols = build_node(_matrix(pdf["v"], dim), pdf["vec_id"].to_numpy(), pdf["uid"].to_numpy(), pivots[key[0]], m)
        return pd.DataFrame([{"region": key[0], "salt": key[1], **cols}])

    return rows.groupBy("region", "salt").applyInPandas(build, NODE)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score over ``vectors`` (vec_id, v) as ``prepared`` gives them."""
    spark = vectors.sparkSession
    ship(spark)
    vs = materialize(vectors, "vectors").withColumn("uid", F.monotonically_increasing_id())
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    m, dim, n = vs.agg(F.max(norm), F.max(F.size("v")), F.count(F.lit(1))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if m >= 2.0 ** 62:
        raise ValueError("squared norms of 2^62 or more: scores need not fit 64 bits")
    dim = max(dim, 1)
    # Routing vectors come from a bounded sample, spread over the table by a hash.
    share = max(1, n // (SAMPLE // 2))
    sample = vs.where(F.pmod(F.xxhash64("uid"), F.lit(share)) == 0).select("v").limit(SAMPLE).toPandas()["v"]
    if not len(sample):
        sample = vs.select("v").limit(1).toPandas()["v"]
    pivots = choose_pivots(_extended(_matrix(sample, dim), m), min(PIVOTS, -(-n // NODE_ROWS)))

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(_distances(_extended(_matrix(v, dim), m), pivots).argmin(axis=1).astype(np.int32))

    placed = materialize(vs.withColumn("region", nearest("v")), "placed")
    counts = {r[0]: r[1] for r in placed.groupBy("region").count().collect()}  # at most PIVOTS rows
    salts = [max(1, -(-counts.get(r, 0) // NODE_ROWS)) for r in range(len(pivots))]
    of = F.element_at(F.array(*[F.lit(s) for s in salts]), F.col("region") + 1)
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("uid"), of).cast("int"))
    nodes = materialize(index(placed, pivots, m, dim), "mtree")
    # A region's radius: the largest of its nodes; at most PIVOTS rows.
    radius = np.zeros(len(pivots))
    for r in nodes.groupBy("region").agg(F.max("radius").alias("radius")).collect():
        radius[r["region"]] = r["radius"]

    queries = placed.where(is_query).select("uid", "vec_id", "region", "salt", "v")
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)).cast("int"))

    def search(key, asked, node):
        if not len(asked) or not len(node):
            return pd.DataFrame({c.split()[0]: [] for c in HIT.split(", ")})
        uid = asked["uid"].to_numpy()
        best = search_node(node.iloc[0], pivots[key[0]], _matrix(asked["v"], dim), uid, asked["kth"].to_numpy(float), k, m)
        return _hits(uid, asked["vec_id"].to_numpy(), best)

    spread = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(asked: DataFrame) -> DataFrame:
        keys = ["region", "salt", "block"]
        return asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(search, HIT)

    home = materialize(run(queries.withColumn("kth", F.lit(float("-inf")))), "home")
    found = home.groupBy("uid").agg(F.first("kth").alias("kth"))

    @F.pandas_udf("array<int>")
    def regions(v: pd.Series, kth: pd.Series) -> pd.Series:
        q = _matrix(v, dim)
        up = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
        reach = _reach((q * q).sum(axis=1), m, kth.to_numpy(float))
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in up - radius[None, :] <= reach[:, None]])

    rest = queries.join(found, "uid", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    rest = rest.withColumn("to", F.explode(regions("v", "kth")))
    at = F.element_at(F.array(*[F.lit(s) for s in salts]), F.col("to") + 1)
    rest = rest.withColumn("part", F.explode(F.sequence(F.lit(0), at - 1))) \
        .where((F.col("to") != F.col("region")) | (F.col("part") != F.col("salt"))) \
        .select("uid", "vec_id", F.col("to").alias("region"), F.col("part").alias("salt"), "block", "v", "kth")
    every = home.unionByName(run(rest)).select("uid", "query_id", "vec_id", "score")
    # A query has at most k hits per node that it visited.
    first = Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
