"""Raw JSON files as a stream (S1, S2, S6, S9, T1): new files since the checkpoint are the increment.

Every line lands in one of two folders, split by batch: bronze rows, or the quarantine with the
reason. A batch that is run again overwrites its own folder, so replays change nothing; the
stream's checkpoint says which files are done.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import jnode
from ..functions.keys import path_partition_key
from ..session import path_exists, store, stored_once
from ..sources.raw import RAW_ENTITIES, envelope_from_text, extract_key, resolve_block_number, unreadable

QUARANTINE = "value string, file_name string, _inserted_timestamp timestamp_ntz, line_hash bigint, reason string"


def read_raw_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of new files with where they come from."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (reader.load(path).where("value <> ''")
            .select("value", F.col("_metadata.file_path").alias("file_name"),
                    F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_inserted_timestamp")))


def split_lines(lines: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantined lines with the reason: unreadable, failed or without a block number)."""
    env = envelope_from_text(lines, "value", F.col("file_name"), F.col("_inserted_timestamp"))
    env = env.withColumn("partition_key", F.coalesce("partition_key", path_partition_key("file_name")))
    env = resolve_block_number(env, full_scan=True)
    for name, path in RAW_ENTITIES[entity].items():
        env = extract_key(env, name, path)
    answered = F.col("data").isNotNull() & jnode("data", "$.error").isNull() | F.col("data_text").isNotNull()
    reason = F.when(~answered, "failed").when(F.col("block_number").isNull(), "no block number")
    read = store(env.withColumn("_reason", reason), "stream")  # read twice below, parsed once
    good = read.where("_reason is null").drop("_reason")
    source = lines.withColumn("line_hash", F.xxhash64("value"))
    bad = read.where("_reason is not null").select("file_name", "line_hash", F.col("_reason").alias("reason")).distinct()
    bad = source.join(bad, ["file_name", "line_hash"]).select("value", "file_name", "_inserted_timestamp", "line_hash", "reason")
    broken = unreadable(lines).select("value", "file_name", "_inserted_timestamp", F.xxhash64("value").alias("line_hash"),
                                      F.lit("unreadable").alias("reason"))
    return good, bad.join(broken, ["file_name", "line_hash"], "left_anti").select(*broken.columns).union(broken)


def ingest_stream(spark: SparkSession, path: str, entity: str, bronze_path: str, quarantine_path: str, checkpoint: str,
                  available_now: bool = True, max_files: int | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Take in what is new below `path`; returns (bronze, quarantine) as they are then, None while nothing arrived."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        with stored_once(batch, "stream") as lines:
            good, bad = split_lines(lines, entity)
            good.write.mode("overwrite").parquet(f"{bronze_path}/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
    w = read_raw_stream(spark, path, max_files).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    w.start().awaitTermination()

    def table(p: str) -> DataFrame | None:
        return spark.read.parquet(p) if path_exists(spark, p) else None
    return table(bronze_path), table(quarantine_path)
