"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of `WINDOW` consecutive words (a shorter item is one window)
and every window into shingles of `SHINGLE` words. A text span that contains a window to the
degree `containment` shares at least r = ceil(containment * n) of its n shingles at their
places, so it shares one of any n - r + 1 of them: the window's prefix, for which the
shingles that are rarest over all documents are taken (one for exact containment).

Three steps, all of them Spark plans:
* rarity: one pass over the documents counts the shingles that items have;
* join: a second pass emits the places where a document may hold a prefix shingle, and these
  join the prefixes on the shingle's hash. The passes test shingles against a bit table that
  Spark aggregates and whose size is fixed (`MAX_BITS`), however large the benchmark: it
  drops what can't match, false positives end in the join;
* bounds and verification: the window must begin and end within the document where the
  shingle's place in it says; then the words themselves are compared, span against window.

The prefixes are broadcast only if their measured count is within the limit, else Spark
shuffles both sides (and splits a shingle that a third of the documents hold). Hit words are
merged as bit masks, per document and stretch of 32 words, before they are shuffled.

Defined cases: null text has no words, an item without words is left out; equal windows of
one or several items are compared once; items with equal ids count as one item, a null id
counts as the empty string; every row of documents gives a row, repeated ones too; an empty
benchmark hits nothing, no documents give no rows; other columns are not looked at.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, stored

WINDOW = 10
SHINGLE = 5
MIN_BITS, MAX_BITS = 20, 25  # size of the bit table, as a power of 2
MASK = 32  # words a mask covers

# bytes of UTF-8: A-Z to lower case, what belongs to no word to a space
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of every run of `size` words (uint64), none if there are fewer."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    crc = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = h * _FACTOR + crc[i:i + n]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


# ---- items ---------------------------------------------------------------------

def _cut_items(window: int, shingle: int):
    def run(batches):
        for b in batches:
            item, spans, hashes = [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(text)
                size = min(window, len(words))
                if not size:
                    continue
                h = shingle_hashes(words, min(shingle, size)).view(np.int64)
                n = size - min(shingle, size) + 1
                for s in range(len(words) - size + 1):
                    item.append(i)
                    spans.append(b" ".join(words[s:s + size]).decode())
                    hashes.append(h[s:s + n])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(spans, pa.string()),
                                              pa.array(hashes, pa.list_(pa.int64()))], names=["item", "span", "hs"])
    return run


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 shingle: int = SHINGLE) -> DataFrame:
    """item, span (its words, joined by a space), hs (hashes of its shingles): a row per window and item."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return rows.mapInArrow(_cut_items(window, shingle), "item string, span string, hs array<bigint>").distinct()


# ---- the bit table ---------------------------------------------------------------

def bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the hashes' leading bits, aggregated by Spark to at most 2^bits / 8 bytes."""
    slot = F.shiftrightunsigned("h", 64 - bits) + 1
    rows = (hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("b")).collect())
    table = np.zeros(2 ** bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["b"]), np.uint8)
        at = (r["k"] - 1) * len(part)
        table[at:at + len(part)] = part
    return table


def _places(table: np.ndarray, bits: int, sizes: list[int]):
    """Function of words: [(shingle size, places, hashes)] of the shingles whose bit is set."""
    is_set = np.unpackbits(table, bitorder="little").view(bool)
    shift = np.uint64(64 - bits)

    def find(words):
        for size in sizes:
            h = shingle_hashes(words, size)
            at = np.flatnonzero(is_set[h >> shift])
            if len(at):
                yield size, at, h[at].view(np.int64)
    return find


def _count(table: np.ndarray, bits: int, sizes: list[int]):
    def run(batches):
        find = _places(table, bits, sizes)
        for b in batches:
            found = [h for t in b.column(0).cast(pa.binary()).to_pylist() for _, _, h in find(words_of(t))]
            h, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])
    return run


_FOUND = "rid bigint, doc_id {}, n_words bigint, h bigint, at bigint, near string, lead int"


def _find(table: np.ndarray, bits: int, sizes: list[int], window: int):
    """A row per document (n_words), and one per place: its words with those around that a window may cover."""
    def run(batches):
        find = _places(table, bits, sizes)
        for b in batches:
            own, total, rows = [], [], ([], [], [], [], [])
            for i, t in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(t)
                total.append(len(words))
                for size, places, hashes in find(words):
                    for at, h in zip(places.tolist(), hashes.tolist()):
                        lo = max(0, at - window + size)
                        for out, v in zip(rows, (h, at, b" ".join(words[lo:at + window]).decode(), at - lo, len(words))):
                            out.append(v)
                        own.append(i)
            n, own = b.num_rows, pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), pa.array(total, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32())], names=_names)
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(own), b.column("doc_id").take(own), pa.array(rows[4], pa.int64()),
                 pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()),
                 pa.array(rows[3], pa.int32())], names=_names)
    return run


_names = ["rid", "doc_id", "n_words", "h", "at", "near", "lead"]


# ---- the join ----------------------------------------------------------------------

def prefixes(windows: DataFrame, counts: DataFrame, containment: float) -> DataFrame:
    """h, off, span, n_span, need: the rarest shingles of a window that any span containing it must share one of."""
    each = windows.select("span", F.posexplode("hs").alias("off", "h"))
    rated = (each.join(counts, "h", "left").groupBy("span")  # at most WINDOW shingles a group
             .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off"))).alias("s")))
    need = F.ceil(F.size("s") * F.lit(containment) - F.lit(1e-9)).cast("int")
    chosen = F.slice("s", F.lit(1), F.size("s") - F.col("need") + 1)
    return (rated.withColumn("need", F.greatest(need, F.lit(1)))
            .select("span", "need", F.size("s").alias("n_shingles"), F.explode(chosen).alias("t"))
            .select("t.h", "t.off", F.split("span", " ").alias("words"), "span", "need", "n_shingles"))


def _shared(near: Column, base: Column, words: Column, n: Column) -> Column:
    """How many of the window's shingles stand at their places in the span that begins at `base`."""
    size = F.size(words) - n + 1
    same = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.slice(near, base + i + 1, size) == F.slice(words, i + 1, size))
    return F.size(same)


def contaminated(docs: DataFrame, items: DataFrame, containment: float = 1.0, window: int = WINDOW, shingle: int = SHINGLE,
                 id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 broadcast_rows: int = 100_000) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit (words within a span that contains a window),
    items (sorted ids, as strings, of the items such windows come from)."""
    if window > MASK or not 0 < containment <= 1:
        raise ValueError("windows of up to 32 words, containment above 0 and up to 1")
    owners = stored(item_windows(items, item_id, item_text, window, shingle))
    windows = owners.select("span", "hs").distinct()
    all_hashes = owners.select(F.explode("hs").alias("h")).distinct()
    n = all_hashes.count()
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(64 * n + 1))))
    width = F.size(F.split("span", " "))
    sizes = [r["s"] for r in windows.select(F.least(width, F.lit(shingle)).alias("s")).distinct().orderBy("s").collect()]
    counts = (docs.select(text_col).mapInArrow(_count(bit_table(all_hashes, bits), bits, sizes), "h bigint, n bigint")
              .groupBy("h").agg(F.sum("n").alias("n")))
    prefix = stored(prefixes(windows, counts, containment))
    n_prefix = prefix.count()
    table = bit_table(prefix.select("h"), bits)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ddl = _FOUND.format(rows.schema["doc_id"].dataType.simpleString())
    found = stored(rows.mapInArrow(_find(table, bits, sizes, window), ddl))
    start, near, base = F.col("at") - F.col("off"), F.split("near", " "), F.col("lead") - F.col("off")
    fits = (start >= 0) & (start + F.size("words") <= F.col("n_words"))
    spans = (found.where("h is not null").join(maybe_broadcast(prefix, n_prefix, broadcast_rows), "h").where(fits)
             .where(_shared(near, base, F.col("words"), F.col("n_shingles")) >= F.col("need"))
             .select("rid", start.alias("start"), F.size("words").alias("len"), "span"))
    spans = stored(spans)
    bits_of = F.expr(f"shiftleft(shiftleft(1L, len) - 1, cast(start % {MASK} as int))")
    low = F.lit(2 ** MASK - 1)
    masks = (spans.select("rid", F.floor(F.col("start") / MASK).alias("k"), bits_of.alias("m"))
             .select("rid", F.explode(F.array(F.struct("k", F.col("m").bitwiseAND(low).alias("m")),
                                              F.struct((F.col("k") + 1).alias("k"), F.shiftrightunsigned("m", MASK).alias("m")))).alias("x"))
             .where("x.m != 0").groupBy("rid", "x.k").agg(F.bit_or("x.m").alias("m"))
             .groupBy("rid").agg(F.sum(F.bit_count("m")).alias("n_hit")))
    names = (spans.select("rid", "span").distinct().join(owners.select("span", "item").distinct(), "span")
             .groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items")))  # as long as the result's own list
    whole = found.where("h is null").select("rid", "doc_id", "n_words")
    return (whole.join(masks, "rid", "left").join(names, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
