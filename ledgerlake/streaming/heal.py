"""Healing as state (T3): rows wait in the stream's state for the parent they lack, and are completed when it comes.

Rows and parents are two streams on one key (a block, a transaction: groups that are bounded by
nature). A row whose parent is known goes out complete. One whose parent is missing goes out at
once with nulls, so that the table has it, and is parked; the parent's arrival sends it again,
complete, without a look at the table or at what was delivered before. A timer gives up on rows that
have waited for `patience_ms`, so that state doesn't grow with parents that never come. The keyed sink
prefers complete rows, so replays and both orders of arrival give the same table.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .stream import upsert_stream

PATIENCE_MS = 14 * 24 * 3600 * 1000
# what such a stream needs of the session: the state store of the state API, and no batches without
# data, which timers would ask for without end (they are looked at in every batch that has data)
_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
             "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


_TEXT = T.StructType([T.StructField("text", T.StringType())])
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_SENT = T.StructType([T.StructField("child", T.StringType()), T.StructField("parent", T.StringType())])


class Park(StatefulProcessor):
    """State of one key: the parent's values once they came, and the rows that wait for them; all as JSON text,
    which keeps every type through Python."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parent = handle.getValueState("parent", _TEXT)
        self.waiting = handle.getListState("waiting", _TEXT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.parent.get()  # every look at the state is a trip to the JVM
        parent = known[0] if known is not None else None
        came: list[str] = []
        for part in rows:
            came += [c for c in part["child"] if isinstance(c, str)]
            for p in part["parent"]:
                if isinstance(p, str):
                    parent = p
                    self.parent.update((p,))
        if parent is not None:
            if known is None:  # nothing waits for a parent that was there before
                waited = [w[0] for w in self.waiting.get()]
                if waited:
                    came = [*waited, *came]
                    self.waiting.clear()
        elif came:
            self.waiting.appendList([(c,) for c in came])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        yield pd.DataFrame({"child": came, "parent": [parent] * len(came)}, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.waiting.clear()  # what waited is in the table already, incomplete
        yield pd.DataFrame({"child": [], "parent": []}, dtype=object)

    def close(self) -> None:
        pass


def heal_rows(rows: DataFrame, parents: DataFrame, key: str, patience_ms: int = PATIENCE_MS) -> DataFrame:
    """The stream of rows with their parents' columns and `complete`, incomplete ones again when their parent comes.

    `parents` holds `key` and the columns to fill in. A parent that comes again counts with its newest values.
    """
    fill = [c for c in parents.columns if c != key]
    nothing = F.lit(None).cast("string")
    both = (rows.select(key, F.to_json(F.struct(*rows.columns), _JSON).alias("child"), nothing.alias("parent"))
            .union(parents.select(key, nothing, F.to_json(F.struct(*fill), _JSON))))
    sent = both.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Park(patience_ms), outputStructType=_SENT, outputMode="Append", timeMode="ProcessingTime")
    child = F.from_json("child", rows.schema, _JSON)
    parent = F.from_json("parent", T.StructType([parents.schema[c] for c in fill]), _JSON)
    return sent.select(child.alias("c"), parent.alias("p"), F.col("parent").isNotNull().alias("complete")).select("c.*", "p.*", "complete")


def heal_stream(rows: DataFrame, parents: DataFrame, key: str, row_keys: list[str], checkpoint: str, table_path: str,
                available_now: bool = True, patience_ms: int = PATIENCE_MS) -> DataFrame | None:
    """Keep `table_path` as every row once, complete as soon as its parent has come. Returns the table, None while it is empty."""
    spark = rows.sparkSession
    before = {k: spark.conf.get(k) for k in _SETTINGS}
    try:
        for k, v in _SETTINGS.items():
            spark.conf.set(k, v)
        return upsert_stream(heal_rows(rows, parents, key, patience_ms), table_path, row_keys,
                             ["complete desc", *[f"{k} asc" for k in row_keys]], checkpoint, available_now)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
