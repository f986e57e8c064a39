"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link when at most `max_bits` bits differ. The bits are cut into
max_bits // 2 + 1 pieces, so that linked fingerprints differ by at most one bit in some
piece. The anchors of a piece are the words of a covering code: a Hamming code on the
first 2^r - 1 bits, all words on the rest. Its covering radius is 1, so every piece has a
home anchor within 1 bit; and a fingerprint is replicated to every anchor within covering
radius plus threshold (1 + 1 bits), 16 anchors and one per remaining bit at most. Homes
are compared with replicas per anchor, on all 64 bits. Only distinct fingerprints are
replicated, an anchor yields a spanning forest instead of all its pairs, and crowded
anchors are compared block by block (runs.py).

Defined cases: null and empty texts and texts of white space have fingerprint 0, which
links like any other; fewer words than a shingle make one shingle; texts are read whole;
rows with equal ids are rows of their own; null ids are never smallest, and a group that
has no other id has component null; an empty table gives an empty result.
"""
from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored, whole_row
from .components import connected_components
from .runs import compare_runs, other_side, spanning_edges

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: bit set when set in over half of the shingle hashes."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = list(accumulate(map(len, parts), lambda at, n: at + n + 1))
    starts = [0, *(e + 1 for e in ends[:len(parts) - words])]
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    h = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1:])], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for s in range(0, len(h), 16384):
        part = h[s:s + 16384]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The SimHash as a signed 64-bit number."""
    @F.pandas_udf("bigint")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(x, words) for x in t], dtype=np.uint64).view(np.int64))
    return run(text)


# ---- anchors ---------------------------------------------------------------

def pieces_of(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the pieces of the 64 bits."""
    m = max_bits // 2 + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def anchors_of(value: np.ndarray, width: int) -> np.ndarray:
    """Anchors within 2 bits of each `width`-bit value, home first; absent ones repeat the home."""
    r = (width + 1).bit_length() - 1  # Hamming code of length 2^r - 1
    n = (1 << r) - 1
    one = np.uint64(1)
    syndrome = np.zeros(len(value), np.int64)
    for k in range(r):
        mask = np.uint64(sum(1 << (p - 1) for p in range(1, n + 1) if p >> k & 1))
        syndrome |= (np.bitwise_count(value & mask).astype(np.int64) & 1) << k
    flip = np.concatenate([[np.uint64(0)], one << np.arange(n, dtype=np.uint64)]).astype(np.uint64)  # by position
    home = value ^ flip[syndrome]
    out = [home]
    i = np.arange(1, n + 1)
    j = i[None, :] ^ syndrome[:, None]
    use = (j > i[None, :]) & (syndrome[:, None] > 0)
    # n // 2 pairs (i, j) with i xor j = syndrome for every value off the code
    cols = np.argsort(~use, axis=1, kind="stable")[:, :n // 2]
    rows = np.arange(len(value))[:, None]
    two = value[:, None] ^ flip[i[cols]] ^ flip[np.where(use, j, 0)[rows, cols]]
    two = np.where(use[rows, cols], two, home[:, None])
    out += list(two.T)
    out += [home ^ (one << np.uint64(p)) for p in range(n, width)]
    return np.stack(out, axis=1)


def _replicas(max_bits: int):
    schema = pa.schema([("piece", pa.int32()), ("anchor", pa.int64()), ("fp", pa.int64()), ("home", pa.int8())])

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for p, (at, width) in enumerate(pieces_of(max_bits)):
                mask = np.uint64((1 << width) - 1)
                anchor = anchors_of((fp >> np.uint64(at)) & mask, width)
                real = np.ones(anchor.shape, bool)
                real[:, 1:] = anchor[:, 1:] != anchor[:, :1]
                r, c = np.nonzero(real)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(r), p, np.int32)), pa.array(anchor[r, c].view(np.int64)),
                     pa.array(fp[r].view(np.int64)), pa.array((c == 0).astype(np.int8))], schema=schema)
    return run


def _linked(max_bits: int):
    """Homes against replicas of each anchor: spanning edges of the links found."""
    def compare(cols, starts):
        fp, home = cols["fp"].view(np.uint64), cols["home"]
        ends = np.append(starts[1:], len(fp))
        busy = (ends - starts > 1) & (np.add.reduceat(home.astype(np.int64), starts) > 0)
        a, b = [], []
        for s, e in zip(starts[busy], ends[busy]):
            x, h = fp[s:e], home[s:e].astype(bool)
            if e - s == 2:
                if int(x[0] ^ x[1]).bit_count() <= max_bits:
                    a.append(x[0])
                    b.append(x[1])
                continue
            near = np.zeros((len(x), len(x)), bool)
            for at in np.array_split(np.flatnonzero(h), max(1, int(h.sum()) // 256)):
                near[at] = np.bitwise_count(x[at][:, None] ^ x[None, :]) <= max_bits
            near |= near.T
            side = other_side(cols, s, e)
            if side is not None:
                near &= side[:, None] != side[None, :]
            for i, j in spanning_edges(near):
                a.append(x[i])
                b.append(x[j])
        return (np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64))
    return compare


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root) of every distinct fingerprint of the one-column frame `fps` that links to another."""
    ddl = "piece int, anchor bigint, fp bigint, home tinyint"
    rows = fps.mapInArrow(_replicas(max_bits), ddl)
    edges = compare_runs(rows, ["piece", "anchor"], _linked(max_bits), partitions(fps.sparkSession))
    return connected_components(edges, "_a", "_b")


def group_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) per row: `fp` is its fingerprint as a signed number,
    `root` names its group, `component_id` is the group's smallest id; text_key is a hash of the text."""
    fps = stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"),
                             fingerprint(F.col(text_col), words).alias("fp")))
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    linked = link_fingerprints(firsts.select("fp"), max_bits)
    rooted = (firsts.join(linked, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("many")))
    # only groups of several fingerprints need the minimum over their members
    groups = rooted.where("many").groupBy(F.col("root").alias("g")).agg(F.min("first").alias("low"))
    named = (rooted.join(groups, F.col("root") == F.col("g"), "left")
             .select(F.col("fp").alias("f"), "root", F.when(F.col("many"), F.col("low")).otherwise(F.col("first"))
                     .alias("component_id")))
    return fps.join(named, F.col("fp") == F.col("f")).drop("f")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """`docs` with one row of each group: the smallest id (null last), then the smallest text hash;
    of rows equal in both, any one."""
    grouped = group_documents(docs, id_col, text_col, **how)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    rows = grouped.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    best = stored(rows.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_key", "copies"), order).alias("k"))
                  .select(F.col("k.doc_id").alias("_k_id"), F.col("k.text_key").alias("_k_text"),
                          F.col("k.copies").alias("_k_n")))
    rows = docs.select(whole_row(docs), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"))
    kept = rows.join(best, F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_text") == F.col("_k_text")))
    if (best.agg(F.max("_k_n")).first()[0] or 0) > 1:
        kept = kept.where("_k_n = 1").union(kept.where("_k_n > 1").dropDuplicates(["_id", "_text"]))
    return kept.select("_row.*")
