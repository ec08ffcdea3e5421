"""Replay of landed files as a stream (an extra: the batch engine does not need it)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from sentrylake.session import scratch_dir


def replay_counts(spark: SparkSession, folder: str, file: str, by: str, *aggregates: Column) -> DataFrame:
    """Aggregates over a file-source stream that takes what has landed so far, then ends.

    State and offsets lie in the shared folder, so a restarted query goes on where it was; each batch
    replaces the result as a whole.
    """
    schema = spark.read.parquet(f"{folder}/{file}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)
    home = f"{scratch_dir(spark)}/replay-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/result")

    running = stream.groupBy(by).agg(*aggregates).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(f"{home}/result")
