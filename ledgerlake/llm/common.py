"""Helpers the corpus operators share."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _stored_at, ensure_checkpoint_dir, remove_path

# a word: a run of characters other than space, tab, LF, VT, FF and CR
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# rows below which a small lookup frame may be broadcast (each row is a few dozen bytes)
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor loses no rows, and what follows never
    repeats the work above. Smaller than checkpoint() for wide or long frames. The write's
    shuffle files go with it.
    """
    return _stored_at(df, f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}")


class Scratch:
    """Stored frames that go when the `with` block ends: what is made of them must be stored by then."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove()

    def remove(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())

    def stored(self, df: DataFrame) -> DataFrame:
        self.paths.append(f"{ensure_checkpoint_dir(self.spark)}/llm-{uuid.uuid4().hex}")
        return _stored_at(df, self.paths[-1])


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a frame whose measured row count is within `limit`."""
    return F.broadcast(df) if rows <= limit else df


def whole_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct, so that no other name of a plan can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
