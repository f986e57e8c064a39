"""Comparing the rows that share a key, without ever holding an unbounded group.

Rows are shuffled by key and sorted; a task reads the runs of equal keys in a stream.
Runs of at most LIMIT rows are compared at once. A longer run is cut into blocks of at
most half that size as it streams by, the last rows of a run included; its rows go on, and
a second pass compares every block with itself and every pair of blocks, each in a group
of its own, which LIMIT rows bound. So no row is dropped, no pair is lost, and no task
compares more than LIMIT rows of a run at once; a longer group in the second pass is an error.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, stored

LIMIT = 2048
BLOCK = LIMIT // 2
# what a pass emits: results, rows of long runs, numbers of blocks of long runs
_RESULT, _ROW, _SIZE = 0, 1, 2

Compare = Callable[[dict, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _columns(t: pa.Table, text: set[str]) -> dict:
    t = t.combine_chunks()
    return {c: t.column(c).to_pylist() if c in text else t.column(c).to_numpy() for c in t.column_names}


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _pass(keys: list[str], text: set[str], schema: pa.Schema, compare: Compare, limit: int, block: int, last: bool = False,
          crowded: Callable[[dict], tuple] | None = None):
    """The function of one pass; the `last` one compares every run and fails on a long one."""
    size_of = block

    def out(kind: int, n: int, /, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)) if f.name == "_kind" else cols[f.name] if f.name in cols
             else pa.nulls(n, f.type) for f in schema], schema=schema)

    def flush(t: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        """Rows of a long run, in blocks numbered from `number` on."""
        if last:
            raise ValueError(f"a group of two blocks has over {limit} rows")
        t = t.combine_chunks()
        for s in range(0, t.num_rows, size_of):
            x = t.slice(s, size_of)
            if crowded:
                yield results(*crowded(_columns(x, text)))
                continue
            cols = {c: x.column(c).chunk(0) for c in x.column_names}
            yield out(_ROW, x.num_rows, _block=pa.array(np.full(x.num_rows, number + s // size_of, np.int32)), **cols)

    def blocks_of(n: int) -> int:
        return -(-n // size_of)

    def results(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return out(_RESULT, len(a), _a=pa.array(a, pa.int64()), _b=pa.array(b, pa.int64()))

    def size(t: pa.Table, blocks: int) -> pa.RecordBatch:
        return out(_SIZE, 0 if crowded else 1, _block=pa.array([] if crowded else [blocks], pa.int32()),
                   **{k: pa.array(t.column(k).to_numpy()[:0 if crowded else 1]) for k in keys})

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if t.num_rows:
            a, b = compare(_columns(t, text), _starts(t, keys))
            if len(a):
                yield results(a, b)

    def run(batches):
        held, blocks = None, 0  # rows of the run that may go on, and its blocks already passed on
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            starts = _starts(t, keys)
            if not len(starts):
                continue
            bounds = np.append(starts, t.num_rows)
            first = 0
            if blocks and len(starts) > 1:  # the long run has ended
                yield from flush(t.slice(0, bounds[1]), blocks)
                yield size(t, blocks + blocks_of(bounds[1]))
                first, blocks = 1, 0
            at = bounds[first]
            if not blocks:
                for i in np.flatnonzero(np.diff(bounds[first:-1]) > limit) + first:
                    yield from compared(t.slice(at, bounds[i] - at))
                    n = bounds[i + 1] - bounds[i]
                    yield from flush(t.slice(bounds[i], n), 0)
                    yield size(t.slice(bounds[i], 1), blocks_of(n))
                    at = bounds[i + 1]
                yield from compared(t.slice(at, bounds[-2] - at))
                at = bounds[-2]
            while t.num_rows - at > limit:  # the open run is already long
                yield from flush(t.slice(at, size_of), blocks)
                blocks, at = blocks + 1, at + size_of
            held = t.slice(at)
        if held is not None and held.num_rows:
            if blocks:
                yield from flush(held, blocks)
                yield size(held, blocks + blocks_of(held.num_rows))
            else:
                yield from compared(held)
    return run


def compare_runs(df: DataFrame, keys: list[str], compare: Compare, n_parts: int, scratch: Scratch | None = None,
                 crowded: Callable[[dict], tuple] | None = None, times: int = 1) -> DataFrame:
    """(_a, _b) rows that `compare` finds among the rows of equal `keys` (integers, not null).

    compare(columns, starts) gets whole runs one after another (`starts`: where each
    begins) and returns two integer arrays. It must find a pair whenever both rows are
    in the run, whichever other rows are there; results may repeat. When columns have
    `_side`, pairs of rows on one side are met elsewhere if the run has both sides.
    What the first pass leaves is kept in `scratch`, if there is one. With `crowded`, the rows of runs of over
    LIMIT rows are not compared: crowded(columns) says what they give, some of them at a time. Narrow rows may go
    in runs and blocks `times` as long: the rows of a long run are sent out once for each of its blocks.
    """
    limit, block = LIMIT * times, BLOCK * times
    types = {"bigint": pa.int64(), "int": pa.int32(), "tinyint": pa.int8(), "binary": pa.binary()}
    spark_type = dict(df.dtypes)
    text = {c for c, t in df.dtypes if t == "binary"}
    ddl = ", ".join(["_kind tinyint", *(f"`{c}` {t}" for c, t in df.dtypes), "_block int", "_a bigint", "_b bigint"])
    schema = pa.schema([("_kind", pa.int8()), *((c, types[t]) for c, t in df.dtypes), ("_block", pa.int32()),
                        ("_a", pa.int64()), ("_b", pa.int64())])

    first = (scratch.stored if scratch else stored)(df.repartition(n_parts, *keys).sortWithinPartitions(*keys)
                                                    .mapInArrow(_pass(keys, text, schema, compare, limit, block, crowded=crowded), ddl))
    found = first.where(F.col("_kind") == _RESULT).select("_a", "_b")
    if crowded:
        return found
    sizes = first.where(F.col("_kind") == _SIZE).select(*keys, F.col("_block").alias("_n"))
    if sizes.isEmpty():
        return found
    rows = first.where(F.col("_kind") == _ROW).select(*spark_type, "_block")
    pairs = (rows.join(sizes, keys).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
             .select(*spark_type, F.least("_block", "_j").alias("_lo"), F.greatest("_block", "_j").alias("_hi"),
                     (F.col("_block") > F.col("_j")).cast("tinyint").alias("_side")))
    both = [*keys, "_lo", "_hi"]
    schema2 = pa.schema([("_kind", pa.int8()), *((c, types[t]) for c, t in pairs.dtypes), ("_block", pa.int32()),
                         ("_a", pa.int64()), ("_b", pa.int64())])
    ddl2 = ", ".join(["_kind tinyint", *(f"`{c}` {t}" for c, t in pairs.dtypes), "_block int", "_a bigint", "_b bigint"])
    second = (pairs.repartition(n_parts, *both).sortWithinPartitions(*both)
              .mapInArrow(_pass(both, text, schema2, compare, limit, block, last=True), ddl2))
    return found.union(second.where(F.col("_kind") == _RESULT).select("_a", "_b"))


def other_side(cols: dict, s: int, e: int) -> np.ndarray | None:
    """The sides of a run's rows when only pairs across them need comparing, else None."""
    side = cols["_side"][s:e] if "_side" in cols else None
    return side if side is not None and side.any() else None


def spanning_edges(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    todo = np.ones(n, bool)
    edges = []
    for i in range(n):
        if not todo[i]:
            continue
        todo[i] = False
        stack = [i]
        while stack:
            x = stack.pop()
            near = np.flatnonzero(linked[x] & todo)
            todo[near] = False
            edges += [(x, int(y)) for y in near]
            stack += near.tolist()
    return edges
