"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct 64-bit hashes of a text's word shingles (five
words; a shorter text is one shingle, a text without words has none). Sketches of parts
merge into the sketch of the whole, and estimate resemblance, containment and the
number of distinct shingles. A fingerprint is the sketch as base64 of little-endian
64-bit numbers in ascending order.

Defined cases: a null text is empty; two sketches without shingles resemble each other
fully (1), one without and one with not at all (0); equal texts have equal sketches;
texts are read whole; an empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 64
SHINGLE_WORDS = 5
CACHE_WORDS = 50_000
_MASK = (1 << 64) - 1
# odd multipliers, one per word of a shingle, from a rule
_MULT = np.array([(0x9E3779B97F4A7C15 * (2 * j + 1) + 0x1F123BB5 * 2 * j) & _MASK | 1 for j in range(64)],
                 dtype=np.uint64)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _WordHash()


def _mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit hash per shingle, repeats included."""
    parts = text.encode().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(w))
    m = len(w) - n + 1
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h += w[j:j + m] * _MULT[j]
    return _mixed(h + np.uint64(n))


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    take = 4 * k
    while len(hashes) > take:
        low = np.unique(np.partition(hashes, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 4
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two parts (each with the same k)."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A or B|; exact when the union has at most k shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A|."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return float(min(1.0, both / distinct_count(a, k)))


def encode(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8").astype(np.uint64)


def sketch_of(text: str | None, k: int = K, words: int = SHINGLE_WORDS) -> np.ndarray:
    return bottom_k(shingle_hashes(text, words), k)


def fingerprint(text, k: int = K, words: int = SHINGLE_WORDS):
    """Fingerprint column of a text column."""
    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([encode(sketch_of(x, k, words)) for x in t], dtype=object)
    return run(text)


def merge_fingerprints(df: DataFrame, group: list[str], col: str = "fingerprint", k: int = K) -> DataFrame:
    """Fingerprint of the union of a group's parts. Each part's hashes are rows, kept to
    the k smallest distinct per group by a window that Spark also limits before the shuffle."""
    @F.pandas_udf("array<decimal(20,0)>")
    def hashes(t: pd.Series) -> pd.Series:
        from decimal import Decimal
        return pd.Series([[Decimal(int(h)) for h in decode(x)] if x else [] for x in t])

    @F.pandas_udf("string")
    def pack(t: pd.Series) -> pd.Series:
        return pd.Series([encode(np.array(sorted(int(h) for h in x), dtype=np.uint64)) for x in t], dtype=object)

    rows = df.select(*group, F.explode_outer(hashes(F.col(col))).alias("_h")).distinct()
    w = Window.partitionBy(*group).orderBy(F.col("_h").asc_nulls_last())
    top = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return top.groupBy(*group).agg(F.collect_list("_h").alias("_hs")).select(*group, pack("_hs").alias(col))


_EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_shingles", pa.float64()),
                     ("kept_in_edited", pa.float64())])
_EDITED_SQL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double, n_shingles double, kept_in_edited double")
# ranges are streamed, so they may be of any size; their number stays small on the driver
MAX_RANGES = 20_000


def _compare(k: int, words: int):
    """Per partition: rows come by range, then in descending id order; a range ends with a
    marked copy of the next range's first row, which only serves as a neighbour."""
    def finish(out, row, nxt):
        doc_id, text, own = row
        other, other_sketch = nxt
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half] if half else text
        changed = sketch_of(edited, k, words)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), encode(own), encode(changed),
                    resemblance(own, changed, k), resemblance(own, other_sketch, k), distinct_count(own, k),
                    containment(own, changed, k)))

    def run(batches):
        held, part = None, None
        for b in batches:
            out = []
            for p, doc_id, text, copy in zip(*(b.column(c).to_pylist() for c in ("_p", "doc_id", "text", "_copy"))):
                text = text or ""
                own = held[2] if held and held[1] == text else sketch_of(text, k, words)
                if held is not None:
                    if part != p:
                        raise RuntimeError("a range lacks its neighbour row")
                    finish(out, held, (text, own))
                held, part = (None if copy else (doc_id, text, own)), p
            yield pa.RecordBatch.from_pydict(
                dict(zip(_EDITED.names, zip(*out))) if out else {c: [] for c in _EDITED.names}, schema=_EDITED)
        if held is not None:
            raise RuntimeError("a range lacks its neighbour row")
    return run


def compare_edited(docs: DataFrame, k: int = K, words: int = SHINGLE_WORDS, rows_per_range: int = 4096) -> DataFrame:
    """Every document against its edited text and against the next document.

    Next is by descending doc_id (null ids last, equal ids by text), after the last the
    first. Texts move once: ids are cut into ranges (quantiles), a range's first row is
    copied to the end of the range before it, and each range is read in order by one
    task that holds two rows at a time. Equal ids share a range; ids are expected unique.
    """
    ids = docs.select(F.col("doc_id").cast("double").alias("_d"))
    n, lo, hi = ids.agg(F.count(F.lit(1)), F.min("_d"), F.max("_d")).first()
    ranges = min(MAX_RANGES, max(1, -(-n // rows_per_range)))
    cuts = []
    if ranges > 1 and lo is not None and hi > lo:
        cuts = sorted(set(ids.approxQuantile("_d", [i / ranges for i in range(1, ranges)], 0.1 / ranges)) - {lo})
    splits = [float("-inf"), *cuts, float("inf")]
    rows = docs.select("doc_id", "text", F.col("doc_id").cast("double").alias("_d"))
    known = F.col("doc_id").isNotNull()
    if len(splits) > 2:
        # bucket 0 has the smallest ids; ranges count down from the largest ids, null ids last
        rows = Bucketizer(splits=splits, inputCol="_d", outputCol="_b", handleInvalid="keep").transform(rows)
        rows = rows.withColumn("_p", F.when(known, F.lit(len(splits) - 2) - F.col("_b").cast("int")).otherwise(
            F.lit(len(splits) - 1)))
    else:
        rows = rows.withColumn("_p", F.when(known, 0).otherwise(1))
    # first row of each range: found on ids alone (one row per range, MAX_RANGES at most), then
    # its text is copied to the range before it
    heads = sorted((r["_p"], r["m"]) for r in rows.groupBy("_p").agg(F.max("doc_id").alias("m")).collect())
    before = {p: heads[i - 1][0] for i, (p, _) in enumerate(heads)}
    lookup = docs.sparkSession.createDataFrame(
        [(p, m, before[p]) for p, m in heads], "_hp int, _hid bigint, _to int")
    rows = rows.select("_p", "doc_id", "text")
    first = (rows.join(F.broadcast(lookup), (F.col("_p") == F.col("_hp")) & F.col("doc_id").eqNullSafe(F.col("_hid")))
             .groupBy("_to", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
             .select(F.col("_to").alias("_p"), "doc_id", "text", F.lit(1).alias("_copy")))
    parted = (rows.withColumn("_copy", F.lit(0)).unionByName(first)
              .repartitionById(heads[-1][0] + 1 if heads else 1, "_p")  # a range a task, none by chance of a hash two
              .sortWithinPartitions("_p", "_copy", F.col("doc_id").desc_nulls_last(),
                                    F.coalesce("text", F.lit(""))))
    return parted.mapInArrow(_compare(k, words), _EDITED_SQL)
