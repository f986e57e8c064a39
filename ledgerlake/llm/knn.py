"""Exact top-k inner products by dual-tree search over a cover tree.

Vectors are taken as integers, floor(scale * x), and equal vectors are one point with its
smallest ids (no more than can matter). The upper level of the tree is shared by queries
and data: centres from a farthest-first cover of a bounded sample, every point at its
nearest centre, and covering radii over all points. Below a centre, points are cut into
blocks of a bounded size; a task builds the lower levels for the queries and the data it
gets (greedy covers of shrinking radius) and walks node pairs from the highest bound down.

A pair (Q, D) is pruned when  cq.cd + |cq| rd + |cd| rq + rq rd  is below the worst k-th
score of Q's queries. Queries first search their own centre, which gives those scores;
then only the data centres that survive get a copy of the queries. The sample only
decides where the centres lie: every point is indexed, and the result is exact.

Defined cases: vectors that are null or hold a null or non-finite component take no part;
shorter vectors count as padded with zeros; rows with equal id and equal vector count
once; a query meets every row but those of its own id; ties go to the smaller id; with
fewer than k candidates all are returned; null ids take no part; an empty table gives an
empty result; other columns are not looked at.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 64
K = 20
SAMPLE = 4096  # vectors the centres are chosen from
MAX_CENTRES = 256
POINTS_PER_CENTRE = 2048
BLOCK = 4096  # points of a centre that one task compares at once
QUERY_CHUNK = 4096
LEAF = 128


def with_slack(reach):
    """A bound raised by more than its rounding, whatever its sign."""
    return reach + 1e-9 * abs(reach) + 1e-6


def integer_vectors(vec: Column, scale: int = SCALE) -> Column:
    """array<bigint> of floor(scale * x); null unless every component is finite."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vec.isNotNull() & fine, F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _matrix(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), "<i8").reshape(-1, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while they hold every partial sum."""
    if not len(a) or not len(b) or a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - c) ** 2).sum(-1), 0.0))


# ---- the lower levels, built within a task -----------------------------------

class Node:
    __slots__ = ("centre", "radius", "norm", "rows", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray):
        """Covers points[rows] from the row nearest their mean."""
        own = points[rows]
        self.centre = own[_distances(own, own.mean(0)).argmin()]
        away = _distances(own, self.centre)
        self.radius, self.norm, self.rows = float(away.max()), float(np.sqrt((self.centre ** 2).sum())), rows
        self.children: list[Node] = []
        if len(rows) > LEAF and self.radius > 0:
            self._split(points, away)

    def _split(self, points: np.ndarray, away: np.ndarray) -> None:
        """Children: a greedy cover at half the radius; what a cover leaves scattered is cut by distance."""
        rows, groups, scattered = self.rows, [], []
        left = np.arange(len(rows))
        while len(left) and len(groups) < 16:
            first = left[away[left].argmax()]
            d = _distances(points[rows[left]], points[rows[first]])
            near = d <= self.radius / 2
            (groups if near.sum() > LEAF // 8 else scattered).append(left[near])
            left = left[~near]
            if len(scattered) > 16:
                break
        rest = np.concatenate([left, *scattered]) if scattered or len(left) else left
        if len(rest):
            rest = rest[np.argsort(away[rest])]
            groups += [rest[i:i + LEAF] for i in range(0, len(rest), LEAF)]
        if len(groups) > 1:
            self.children = [Node(points, rows[g]) for g in groups]

    def leaves(self):
        if not self.children:
            yield self
        for c in self.children:
            yield from c.leaves()


def bound(q: Node, d: Node) -> float:
    """No inner product of a point of q and one of d exceeds this."""
    return float(q.centre @ d.centre) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius


def dual_search(queries: np.ndarray, floor: np.ndarray, data: np.ndarray, first_id: np.ndarray, k: int):
    """(query row, data row, score): per query its k best data rows (score, then first id) that reach
    the query's floor, a score it has already."""
    if not len(queries) or not len(data):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    x, y = queries.astype(np.float64), data.astype(np.float64)
    root = Node(y, np.arange(len(y)))
    found = []
    for q in Node(x, np.arange(len(x))).leaves():
        rows = q.rows
        own, worst = queries[rows], floor[rows].astype(np.float64).copy()
        cand: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        stack = [(bound(q, root), root)]
        while stack:
            reach, d = stack.pop()
            if with_slack(reach) < worst.min():
                continue
            if d.children:
                stack += sorted(((bound(q, c), c) for c in d.children), key=lambda e: e[0])
                continue
            cand.append((d.rows, products(own, data[d.rows])))
            held += len(d.rows)
            if held >= max(k, 512) or not stack:
                cand, worst = _best(cand, first_id, worst, k)
                held = 0
        if cand:
            (which, score), = _best(cand, first_id, worst, k)[0]
            r, c = np.nonzero(score >= floor[rows][:, None])
            found.append((rows[r], which[r, c], score[r, c]))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(v) for v in zip(*found))


_NONE = np.iinfo(np.int64).min


def _best(cand: list, first_id: np.ndarray, worst: np.ndarray, k: int):
    """Merge candidate lists into the k best per query, and raise the queries' k-th scores."""
    n = len(worst)
    which = np.concatenate([np.broadcast_to(w, (n, w.shape[-1])) for w, _ in cand], axis=1)
    score = np.concatenate([s for _, s in cand], axis=1)
    if which.shape[1] > k:
        if np.abs(score.astype(np.float64)).max() < 2.0 ** 53:
            order = np.lexsort((first_id[which], -score), axis=1)[:, :k]
        else:  # negation could overflow
            order = np.stack([sorted(range(len(s)), key=lambda j: (-int(s[j]), int(first_id[w[j]])))[:k]
                              for s, w in zip(score, which)])
        which, score = np.take_along_axis(which, order, 1), np.take_along_axis(score, order, 1)
    if which.shape[1] >= k:
        worst = np.maximum(worst, score.min(1))
    return [(which, score)], worst


# ---- the upper level and the Spark plan ----------------------------------------

def centres_of(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first cover of the sample with at most n centres."""
    x = sample.astype(np.float64)
    chosen = [int(_distances(x, x.mean(0)).argmin())]
    away = _distances(x, x[chosen[0]])
    while len(chosen) < min(n, len(x)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _distances(x, x[chosen[-1]]))
    return x[chosen]


def _assign(centres: np.ndarray, dim: int):
    norms = (centres ** 2).sum(1)

    def run(batches):
        for b in batches:
            x = _matrix(b.column("vec").to_pylist(), dim).astype(np.float64)
            node = (norms[None, :] - 2 * x @ centres.T).argmin(1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(node.astype(np.int32)), pa.array(_distances(x, centres[node]))],
                names=[*b.schema.names, "node", "away"])
    return run


def _block(blocks: list[int]) -> Column:
    """A point's block within its centre: as many blocks as its size needs."""
    n = F.get(F.array(*[F.lit(b) for b in blocks]), F.col("node"))
    return F.pmod(F.xxhash64("vec"), n).cast("int")


def _copies(alive: np.ndarray, centres: np.ndarray, radius: np.ndarray, blocks: list[int], dim: int, own: bool):
    """A query row for each data centre (and block) that survives for its group and for itself."""
    def run(batches):
        for b in batches:
            x = _matrix(b.column("vec").to_pylist(), dim).astype(np.float64)
            node, floor = b.column("node").to_numpy(), b.column("floor").to_numpy()
            if own:
                keep = np.arange(len(centres))[None, :] == node[:, None]
            else:
                reach = x @ centres.T + np.sqrt((x ** 2).sum(1))[:, None] * radius[None, :]
                keep = alive[node] & (with_slack(reach) >= floor[:, None])
                keep[np.arange(len(node)), node] = False
            r, c = np.nonzero(keep)
            times = np.array(blocks, np.int64)[c]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            r, c = np.repeat(r, times), np.repeat(c, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int32)), pa.array(part.astype(np.int32)), b.column("vk").take(pa.array(r)),
                 b.column("vec").take(pa.array(r)), pa.array(floor[r])], names=["node", "block", "vk", "vec", "floor"])
    return run


def _search(dim: int, k: int):
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        ids = d["ids"].tolist()
        first = np.array([i[0] for i in ids], np.int64)
        a, b, s = dual_search(_matrix(q["vec"], dim), q["floor"].to_numpy(), _matrix(d["vec"], dim), first, k)
        vk = q["vk"].to_numpy()
        n = np.array([len(ids[i]) for i in b], np.int64)
        own = np.concatenate([ids[i] for i in b]).astype(np.int64) if len(b) else np.empty(0, np.int64)
        return pd.DataFrame({"q": np.repeat(vk[a], n), "vec_id": own, "score": np.repeat(s, n)})
    return run


def _limited(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner product per query row."""
    spark = vectors.sparkSession
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("id"), integer_vectors(F.col(vec_col), scale).alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where("id is not null and v is not null"))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if dim == 0:
        return empty

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        out = np.zeros((len(v), dim), "<i8")
        for i, x in enumerate(v):
            out[i, :len(x)] = x
        return pd.Series([r.tobytes() for r in out])
    rows = stored(rows.select("id", packed("v").alias("vec"), "asks").distinct())
    # one point per vector, with the ids that can be among the k best besides the query itself
    smallest = Window.partitionBy("vec").orderBy("id")
    ids = (rows.select("vec", "id").distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
           .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asks = rows.groupBy("vec").agg(F.max("asks").alias("asks"))
    points = stored(ids.join(asks, "vec").withColumn("vk", F.monotonically_increasing_id()))
    n = points.count()
    sample = points.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").collect()
    sample = _matrix([bytes(r["vec"]) for r in sample], dim)
    centres = centres_of(sample, min(MAX_CENTRES, -(-n // POINTS_PER_CENTRE)))
    placed = stored(points.mapInArrow(_assign(centres, dim), "vec binary, ids array<bigint>, asks boolean, vk bigint, "
                                                             "node int, away double"))
    stats = {r["node"]: r for r in placed.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("r"), F.max(F.when(F.col("asks"), F.col("away"))).alias("rq"),
        F.count(F.when(F.col("asks"), 1)).alias("nq")).collect()}
    nodes = range(len(centres))
    radius = np.array([stats[i]["r"] if i in stats else 0.0 for i in nodes])
    q_radius = np.array([(stats[i]["rq"] if i in stats else None) or 0.0 for i in nodes])
    blocks = [-(-stats[i]["n"] // BLOCK) if i in stats else 1 for i in nodes]
    chunks = max(1, -(-sum(s["nq"] for s in stats.values()) // QUERY_CHUNK))
    data = (placed.withColumn("block", _block(blocks))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select("node", "block", "chunk", "vec", "ids"))
    ddl = "node int, block int, vk bigint, vec binary, floor bigint"

    def searched(queries: DataFrame, alive: np.ndarray, own: bool) -> DataFrame:
        q = (queries.mapInArrow(_copies(alive, centres, radius, blocks, dim, own), ddl)
             .withColumn("chunk", F.pmod(F.xxhash64("vk"), F.lit(chunks)).cast("int")))
        keys = ["node", "block", "chunk"]
        return (q.groupBy(*keys).cogroup(data.groupBy(*keys))
                .applyInPandas(_search(dim, k + 1), "q bigint, vec_id bigint, score bigint"))

    queries = placed.where("asks").select("vk", "vec", "node", F.lit(_NONE).alias("floor"))
    none = np.zeros((len(centres), len(centres)), bool)
    near = stored(_limited(searched(queries, none, True), k + 1))
    # the (k+1)-th score a query has from its own centre
    have = near.where(F.col("place") == k + 1).select("q", F.col("score").alias("s"))
    queries = stored(queries.drop("floor").join(have, F.col("vk") == F.col("q"), "left")
                     .select("vk", "vec", "node", F.coalesce("s", F.lit(_NONE)).alias("floor")))
    worst = {r["node"]: r["w"] for r in queries.groupBy("node").agg(F.min("floor").alias("w")).collect()}
    norm = np.sqrt((centres ** 2).sum(1))
    reach = (centres @ centres.T + norm[:, None] * radius[None, :] + norm[None, :] * q_radius[:, None]
             + q_radius[:, None] * radius[None, :])
    floor = np.array([float(worst.get(i, 0)) for i in nodes])
    alive = with_slack(reach) >= floor[:, None]
    far = searched(queries, alive, False)
    best = stored(_limited(near.select("q", "vec_id", "score").union(far), k + 1))
    asked = rows.where("asks").select(F.col("id").alias("query_id"), "vec").distinct()
    asked = asked.join(placed.select(F.col("vec").alias("v"), "vk"), F.col("vec") == F.col("v")).select("query_id", "vk")
    hits = asked.join(best, F.col("vk") == F.col("q")).where("vec_id != query_id")
    w = Window.partitionBy("query_id", "vk").orderBy("place")
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
