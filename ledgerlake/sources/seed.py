"""Seed CSV (S10) and declared sources."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "workflow_name STRING, workflow_schedule STRING"


def read_seed(spark: SparkSession, path: str, schema: str = SEED_SCHEMA) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


class Catalog:
    """Declared sources by name -> temp views (no metastore needed)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, tuple[str, str]] = {}

    def register(self, name: str, path: str, fmt: str = "parquet") -> DataFrame:
        df = self.spark.read.format(fmt).load(path)
        df.createOrReplaceTempView(name)
        self.paths[name] = (path, fmt)
        return df

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)
