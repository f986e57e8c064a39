"""Best-fit packing by bin completion.

Documents become pieces of at most CAPACITY tokens. What to pack is the histogram of
piece lengths: CAPACITY numbers whatever the size of the table, so the driver can search
over it. The search fills sequences around the largest remaining length: it enumerates
the undominated fillings of the rest of a sequence, tries them from the least waste,
takes a filling as often as the counts allow, and backtracks; a branch ends when its
waste could no longer beat the incumbent. The first incumbent is best-fit decreasing,
and the search stops at the lower bound or after MAX_NODES nodes (the incumbent is then
the answer; every answer is a whole, valid packing). The search is cut in other places too:
a node tries MAX_FILLINGS fillings, enumerated from the lengths of _TRIED (four at most;
of more only the greedy one), and a filling is never taken fewer times on backtracking. So
a search that ends below MAX_NODES doesn't prove its answer the best. Tasks then place their pieces from
the plan: the n-th piece of a length has its sequence and offset by arithmetic, without
moving texts or tokens.

Defined cases: null and empty texts are one end token; texts are read whole and only
longer documents are cut; repeated rows are pieces of their own; an empty table gives an
empty result; other columns are not looked at.
"""
from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import maybe_broadcast, stored

CAPACITY = 2048
END_ID = 0
MAX_NODES = 4_000
MAX_FILLINGS = 8  # tried per node, least waste first
CACHE_WORDS = 150_000


# ---- tokens ----------------------------------------------------------------

# Latin texts that the tokenizer's normaliser leaves alone but for lower case; other texts take the library's way
_OTHER = re.compile(r"[^\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]|<\|")
_SPLIT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")


class _Ids(dict):
    """Token ids of words seen, as packed 32-bit numbers; bounded: forgotten as a whole when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self.encode(word)
        return ids


class TokenIds:
    """Little-endian 32-bit ids of a text, equal to the tokenizer library's own.

    A word-end BPE vocabulary is applied word by word with a cache: each word's merges run
    on its bytes plus one byte that marks the word end (0xFF, which UTF-8 never uses).
    """

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None  # the library is loaded when a text needs it
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.words = spec["model"], None
        splits = [p["pattern"]["Regex"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        # Fixed value: the split pattern that _SPLIT restates for Latin text
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["dropout"] or splits != [
                r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]:
            return
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in special:
                core = token.removesuffix("</w>")
                ranks[bytes(byte_of[c] for c in core) + (b"\xff" if core != token else b"")] = i
        free = max(ranks.values()) + 1
        for b in range(256):
            if bytes([b]) not in ranks:
                ranks[bytes([b])] = free
                free += 1
        import tiktoken
        bpe = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        merge = bpe._core_bpe.encode_single_piece
        self.words = _Ids(lambda w: array("I", merge(w.encode() + b"\xff")).tobytes())

    def __call__(self, text: str) -> bytes:
        if self.words is None or _OTHER.search(text):
            if self.tokenizer is None:
                from tokenizers import Tokenizer
                self.tokenizer = Tokenizer.from_file(self.path)
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower())))


_LOADED: dict[str, TokenIds] = {}
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())])
_PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        if path not in _LOADED:
            _LOADED[path] = TokenIds(path)
        ids_of, end = _LOADED[path], array("I", [end_id]).tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                ids = (ids_of(text) if text else b"") + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((doc_id, n, at // 4, length, zlib.crc32(own), part, int(seen[length])))
                    seen[length] += 1
            yield pa.RecordBatch.from_pydict(dict(zip(_PIECES.names, zip(*rows))) if rows else
                                             {n: [] for n in _PIECES.names}, schema=_PIECES)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece; `part` and `nth` number the pieces of each length."""
    return stored(docs.select(F.col(id_col).cast("bigint"), F.col(text_col))
                  .mapInArrow(_cut(tokenizer_path, capacity, end_id), _PIECES_DDL))


# ---- the search over the histogram -------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: (lengths of a sequence, how many such sequences)."""
    room: dict[int, list[list]] = {}  # free space -> [filling, times]
    spaces: list[int] = []  # the keys of room, ascending

    def put(free: int, filling: tuple[int, ...], times: int) -> None:
        if free not in room:
            insort(spaces, free)
            room[free] = []
        room[free].append([filling, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                each = min(left, capacity // length)
                times = left // each
                put(capacity - each * length, (length,) * each, times)
                left -= each * times
                continue
            free = spaces[i]
            filling, times = room[free].pop()
            each = min(free // length, max(1, left // times))
            used = min(times, left // each)
            if used < times:
                room[free].append([filling, times - used])
            if not room[free]:
                del room[free]
                spaces.pop(i)
            put(free - each * length, filling + (length,) * each, used)
            left -= used * each
    return [(f, t) for groups in room.values() for f, t in groups]


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether filling b's lengths can be dealt to filling a's places (Martello and Toth)."""
    if sum(b) > sum(a):
        return False
    if len(a) == 1:
        return True

    def deal(rest: tuple[int, ...], places: list[int]) -> bool:
        if not rest:
            return True
        tried = set()
        for i, p in enumerate(places):
            if p >= rest[0] and p not in tried:
                tried.add(p)
                places[i] -= rest[0]
                if deal(rest[1:], places):
                    return True
                places[i] += rest[0]
        return False
    return deal(tuple(sorted(b, reverse=True)), list(a))


# how many lengths are tried for each place of a filling of 1, 2, 3 and 4 lengths, largest first;
# the last length is always the largest that fits
_TRIED = ((1,), (64, 1), (12, 12, 1), (6, 6, 6, 1))


def fillings(counts: np.ndarray, room: int, waste: int, most: int = MAX_FILLINGS) -> list[tuple[int, ...]]:
    """Undominated fillings of `room` from the counts that waste at most `waste`, least waste first.

    Fillings of up to four lengths are enumerated (_TRIED), and the one that fills by
    decreasing length with as many as fit.
    """
    if room == 0 or not counts[:room + 1].any():
        return [()] if room <= waste else []
    lengths = np.arange(room + 1)
    below = np.maximum.accumulate(np.where(counts[:room + 1] > 0, lengths, 0)).tolist()  # largest present <= v
    found: set[tuple[int, ...]] = set()

    def seek(left: int, top: int, chosen: tuple[int, ...], tries: tuple[int, ...]) -> None:
        x = below[min(left, top)]
        for _ in range(tries[0]):
            while x and chosen.count(x) >= counts[x]:
                x = below[x - 1]
            if not x:
                return
            if len(tries) > 1:
                seek(left - x, x, chosen + (x,), tries[1:])
            elif left - x <= waste:
                found.add(chosen + (x,))
            x = below[x - 1]

    for tries in _TRIED:
        seek(room, room, (), tries)
        if any(sum(f) == room for f in found if len(f) == 1):
            break  # one length that fills the room dominates every other filling
    left, own, x = room, [], below[room]
    while x and left:
        k = min(left // x, int(counts[x]))
        own += [x] * k
        left -= k * x
        x = below[min(left, x - 1)]
    if left <= waste:
        found.add(tuple(own))
    kept: list[tuple[int, ...]] = []
    for f in sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f])):
        if len(kept) >= most:
            break
        if not any(dominates(k, f) for k in kept):
            kept.append(f)
    return kept


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY,
                 max_nodes: int = MAX_NODES) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), together exactly the histogram."""
    histogram = {k: v for k, v in histogram.items() if v}
    total = sum(k * v for k, v in histogram.items())
    best = best_fit(histogram, capacity)
    best_n = sum(t for _, t in best)
    # two lengths over half never share a sequence
    bound = max(-(-total // capacity), sum(v for k, v in histogram.items() if 2 * k > capacity))
    counts = np.zeros(capacity + 1, np.int64)
    for k, v in histogram.items():
        counts[k] = v
    stack: list[tuple] = []  # (filling, times, remaining choices) of each level
    used = wasted = nodes = 0

    def choices() -> list[tuple[int, ...]]:
        big = int(np.flatnonzero(counts)[-1])
        counts[big] -= 1
        allowed = (best_n - 1) * capacity - total - wasted
        out = [(big, *f) for f in fillings(counts, capacity - big, min(allowed, capacity))] if allowed >= 0 else []
        counts[big] += 1
        return out

    def times_of(filling: tuple[int, ...]) -> int:
        lengths, mult = np.unique(filling, return_counts=True)
        times = int((counts[lengths] // mult).min())
        gap = capacity - sum(filling)
        spare = (best_n - 1) * capacity - total - wasted
        return max(1, min(times, spare // gap)) if gap else times

    todo = choices() if total and best_n > bound else []
    while best_n > bound and nodes < max_nodes:
        if todo:
            nodes += 1
            filling, todo = todo[0], todo[1:]
            times = times_of(filling)
            for x in filling:
                counts[x] -= times
            used += times
            wasted += times * (capacity - sum(filling))
            stack.append((filling, times, todo))
            if not counts.any():
                if used < best_n:
                    best, best_n = [(f, t) for f, t, _ in stack], used
                todo = []
            else:
                todo = choices() if wasted <= (best_n - 1) * capacity - total else []
        elif stack:
            filling, times, todo = stack.pop()
            for x in filling:
                counts[x] += times
            used -= times
            wasted -= times * (capacity - sum(filling))
        else:
            break
    return best


# ---- placing -----------------------------------------------------------------

_SHIFT = 44  # ranks of a length are below 2^44


def _places(plan: list[tuple[tuple[int, ...], int]], first_sequence: int = 0):
    """Sorted keys (length, first rank) with the sequence and offset of that rank."""
    taken: dict[int, int] = {}
    keys, sequences, offsets = [], [], []
    sequence = first_sequence
    for filling, times in plan:
        at = 0
        for x in filling:
            rank = taken.get(x, 0)
            keys.append((x << _SHIFT) + rank)
            sequences.append(sequence)
            offsets.append(at)
            taken[x] = rank + times
            at += x
        sequence += times
    keys, sequences, offsets = (np.array(v, np.int64) for v in (keys, sequences, offsets))
    order = np.argsort(keys)
    return keys[order], sequences[order], offsets[order]


def _placed(keys: np.ndarray, sequences: np.ndarray, offsets: np.ndarray):
    def run(batches):
        for b in batches:
            key = (b.column("length").to_numpy() << _SHIFT) + b.column("rank").to_numpy()
            i = np.searchsorted(keys, key, side="right") - 1
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(sequences[i] + key - keys[i]), pa.array(offsets[i])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **how) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = pieces(docs, tokenizer_path, capacity=capacity, **how)
    per_part = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    keys, sequences, offsets = _places(plan_packing(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select(F.col("part").alias("p"), F.col("length").alias("l"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = (cut.join(maybe_broadcast(first, per_part.count()), (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank")))
    return ranked.mapInArrow(_placed(keys, sequences, offsets),
                             "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                             "sequence_id bigint, offset bigint")
