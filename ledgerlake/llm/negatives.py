"""Hard-negative mining by Kronecker-packed products.

Vectors are taken as integers, floor(scale * x). A block of candidates becomes one wide
integer per component: candidate j's component, made non-negative by a bias, fills bits
[j * F, (j + 1) * F). An anchor's component multiplies that integer once, which multiplies the
component of every candidate of the block; summed over the components and lifted by a constant
that keeps every field non-negative, the integer's fields hold all inner products of the anchor
with the block. F is taken from the measured range of the components, so that no field can run
over into the next: scores are exact.

Candidates lie in blocks of a bounded size, ordered by label: one range shuffle, which splits
a label that a third of the rows have. Anchors are taken in slabs of a bounded number of bytes,
one after the other; a slab goes to all tasks, the blocks stay where they are. Within a slab a
first job finds the anchors' positives from the blocks that hold their label, a second one the
negatives within each positive's band from blocks of other labels. A task keeps the best of each
anchor over all its blocks, and what tasks found is merged by Spark. Slabs' results are written
before the next slab begins.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite
component take no part; shorter vectors count as padded with zeros; rows equal in id, label
and integer vector count once; a row is no partner of rows of its own id; ties go to the smaller id;
scores beyond 64 bits are compared exactly and returned as the nearest long; an anchor
without positives, or a positive without negatives, gives no rows; other columns are not looked at.
"""
from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .knn import integer_vectors

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative scores from LOW to HIGH per cent of the positive
BLOCK_BYTES = 1 << 20  # wide integers of a block
FILE_BYTES = 1 << 24  # blocks a task gets, about
SLAB_BYTES = 1 << 23  # anchors taken at a time
_LONG = 2 ** 63


class Fields:
    """The layout of the wide integers for components of at most `top` in size and `dim` of them."""

    def __init__(self, top: int, dim: int):
        self.bias, self.dim = top, dim
        self.lift = 2 * top * top * dim  # no sum of dim products of a component and a biased one is larger
        bits = (2 * self.lift).bit_length()
        self.width = 4 if bits <= 32 else 8 if bits < 64 else -(-bits // 8)
        self.rows = max(16, BLOCK_BYTES // max(1, dim * self.width))

    def pack(self, vectors: np.ndarray) -> bytes:
        """One wide integer per component, as bytes."""
        if self.width <= 8:
            return (vectors + self.bias).T.astype(f"<u{self.width}").tobytes()
        return b"".join((int(x) + self.bias).to_bytes(self.width, "little") for x in vectors.T.ravel())

    def wide(self, packed: bytes, n: int) -> list[int]:
        step = n * self.width
        return [int.from_bytes(packed[i * step:(i + 1) * step], "little") for i in range(self.dim)]

    def lifts(self, n: int) -> int:
        return int.from_bytes(self.lift.to_bytes(self.width, "little") * n, "little")

    def scores(self, anchor: list[int], wide: list[int], lifts: int, n: int) -> np.ndarray:
        """Inner products of an anchor with the n candidates of a block: int64, or exact Python integers."""
        fields = (sum(map(mul, anchor, wide)) + lifts).to_bytes(n * self.width, "little")
        away = self.lift + self.bias * sum(anchor)
        if self.width <= 8:
            return np.frombuffer(fields, f"<u{self.width}").astype(np.int64) - away
        w = self.width
        return np.array([int.from_bytes(fields[i:i + w], "little") - away for i in range(0, n * w, w)] + [None], object)[:n]


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    """int64 rows of a list column, padded with zeros."""
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(col), dim), np.int64)
    out[np.arange(dim)[None, :] < size[:, None]] = flat
    return out


def _pack_blocks(fields: Fields):
    """Rows ordered by label and id -> blocks; a row equal to the one before it is left out."""
    def emit(i, lab, v):
        return pa.RecordBatch.from_pydict({"ids": pa.array([i.astype("<i8").tobytes()], pa.binary()),
                                           "labels": pa.array([lab.astype("<i8").tobytes()], pa.binary()),
                                           "packed": pa.array([fields.pack(v)], pa.binary())})

    def run(batches):
        held, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            new = (b.column("id").to_numpy(), b.column("label").to_numpy(), _vectors(b.column("v"), fields.dim))
            if last is None:
                keep = np.ones(len(new[0]), bool)
            else:
                keep = np.array([not all(np.array_equal(x[:1], y) for x, y in zip(new, last))] + [True] * (len(new[0]) - 1))
            keep[1:] &= (new[0][1:] != new[0][:-1]) | (new[1][1:] != new[1][:-1]) | (new[2][1:] != new[2][:-1]).any(1)
            last = tuple(x[-1:] for x in new)
            new = tuple(x[keep] for x in new)
            held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new))
            while len(held[0]) >= fields.rows:
                yield emit(*(x[:fields.rows] for x in held))
                held = tuple(x[fields.rows:] for x in held)
        if held is not None and len(held[0]):
            yield emit(*held)
    return run


class Best:
    """The k best (score, then smaller id) of each key, with the key's k-th score as a bar."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def bar(self, key):
        s = self.of.get(key)
        return s[0][-1] if s is not None and len(s[0]) >= self.k else None

    def add(self, key, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(score):
            return
        old = self.of.get(key)
        if old is not None:
            score, ids = np.concatenate([old[0], score]), np.concatenate([old[1], ids])
        order = np.lexsort((ids, -score))[:self.k]
        self.of[key] = score[order], ids[order]


def _search(fields: Fields, slab: tuple, wanted, k: int):
    """Per block and anchor `wanted(anchor, labels of the block)` gives (keys, row mask, bands) to look for."""
    ids, labels, vectors = slab

    def run(batches):
        best = Best(k)
        for b in batches:
            for own, lab, packed in zip(*(b.column(c).to_pylist() for c in ("ids", "labels", "packed"))):
                own, lab = np.frombuffer(own, "<i8"), np.frombuffer(lab, "<i8")
                n = len(own)
                wide, lifts = fields.wide(packed, n), fields.lifts(n)
                for a in wanted.anchors(lab):
                    score = fields.scores(vectors[a].tolist(), wide, lifts, n)
                    rows = wanted.rows(a, lab) & (own != ids[a])
                    for key, low, high in wanted.bands(a):
                        bar = best.bar((a, key))
                        low = bar if bar is not None and (low is None or bar > low) else low
                        fit = rows if low is None else rows & (score >= low).astype(bool)
                        fit = fit if high is None else fit & (score <= high).astype(bool)
                        if fit.any():
                            best.add((a, key), score[fit], own[fit])
        found = [(a, key, int(i), max(-_LONG, min(_LONG - 1, int(s)))) for (a, key), (ss, ii) in best.of.items()
                 for s, i in zip(ss, ii)]
        cols = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                         names=["a", "key", "id", "score"])
    return run


class _Same:
    """Rows of an anchor's own label."""

    def __init__(self, labels: np.ndarray):
        self.labels = labels

    def anchors(self, lab):
        return np.flatnonzero(np.isin(self.labels, lab)).tolist()

    def rows(self, a, lab):
        return lab == self.labels[a]

    def bands(self, a):
        return [(0, None, None)]


class _Other:
    """Rows of other labels within the band of each of the anchor's positives."""

    def __init__(self, labels: np.ndarray, bands: dict):
        self.labels, self.band = labels, bands

    def anchors(self, lab):
        only = lab[0] if (lab == lab[0]).all() else None
        return [a for a in self.band if only is None or self.labels[a] != only]

    def rows(self, a, lab):
        return lab != self.labels[a]

    def bands(self, a):
        return self.band[a]


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")  # at most k rows of a key from a task
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding",
         slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and each of its
    best `positives` rows of the same label, the best `negatives` rows of other labels whose score is
    between `low` and `high` per cent of the positive's."""
    spark = vectors.sparkSession
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                           integer_vectors(F.col(vec_col), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
            .where("id is not null and label is not null and v is not null"))
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.min(F.array_min("v")).alias("lo"),
                 F.max(F.array_max("v")).alias("hi"), F.count(F.when(F.col("asks"), 1)).alias("asks")).first()
    if not r["dim"] or not r["asks"]:
        return spark.createDataFrame([], out)
    fields = Fields(max(-r["lo"], r["hi"], 1), r["dim"])
    parts = max(spark.sparkContext.defaultParallelism, -(-r["n"] * r["dim"] * fields.width // FILE_BYTES))
    blocks = stored(rows.select("id", "label", "v").repartitionByRange(parts, "label", "id").sortWithinPartitions("label", "id", "v")
                    .mapInArrow(_pack_blocks(fields), "ids binary, labels binary, packed binary"))
    slabs = -(-r["asks"] * r["dim"] * 8 // slab_bytes)
    asks = stored(rows.where("asks").select("id", "label", "v").distinct()
                  .withColumn("slab", F.pmod(F.xxhash64("id", "v"), F.lit(slabs)).cast("int")))
    ddl, mined = "a bigint, key int, id bigint, score bigint", []
    for s in range(slabs):
        t = asks.where(F.col("slab") == s).toArrow().combine_chunks().sort_by([("label", "ascending"), ("id", "ascending")])
        if not t.num_rows:
            continue
        ids, labels = t.column("id").to_numpy(), t.column("label").to_numpy()
        slab = ids, labels, _vectors(t.column("v").combine_chunks(), r["dim"])
        near = _first(blocks.mapInArrow(_search(fields, slab, _Same(labels), positives), ddl), ["a"], positives)
        near = near.orderBy("a", "rank").collect()  # `positives` rows an anchor of the slab
        bands: dict = {}
        for p in near:
            bands.setdefault(p["a"], []).append((p["rank"], -(-low * p["score"] // 100), high * p["score"] // 100))
        bands = {a: kept for a, b in bands.items() if (kept := [x for x in b if x[1] <= x[2]])}
        if not bands:
            continue
        far = _first(blocks.mapInArrow(_search(fields, slab, _Other(labels, bands), negatives), ddl), ["a", "key"], negatives)
        own = spark.createDataFrame([(p["a"], p["rank"], int(ids[p["a"]]), p["id"], p["score"]) for p in near],
                                    "a bigint, key int, anchor_id bigint, positive_id bigint, positive_score bigint")
        mined.append(stored(far.join(F.broadcast(own), ["a", "key"])
                            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                    F.col("score").alias("negative_score"))))
    if not mined:
        return spark.createDataFrame([], out)
    result = mined[0]
    for m in mined[1:]:
        result = result.unionByName(m)
    return result
