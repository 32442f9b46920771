"""New documents as they arrive, in batches or as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def shard_of(name: Column | str, shards: int = 100) -> Column:
    """A file's shard: the last digits of the number its name starts with."""
    return F.pmod(F.regexp_extract(name, r"^([0-9]+)", 1).try_cast("bigint"), F.lit(shards))


def new_inputs(inputs: DataFrame, done: DataFrame, shard: int | None = None) -> DataFrame:
    """Inputs that have no output yet, of one shard if asked (A11). inputs, done: name."""
    out = inputs.join(done.select("name").distinct(), "name", "left_anti")
    return out if shard is None else out.where(shard_of("name") == shard)


def stream_documents(spark: SparkSession, path: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Every arriving file of documents goes through the transform used in batches, once.

    Documents arrive whole, so windows over a document run inside a micro-batch;
    a repeated batch overwrites its own folder, so results stay exact after a failure.
    """
    source = spark.readStream.schema(schema).parquet(path)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
