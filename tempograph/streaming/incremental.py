"""Incremental processing: what a stored output already has isn't processed again, and what is processed again counts once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def process_new(spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Process the source files that no earlier run has seen, then stop. The checkpoint makes each file count once."""
    stream = transform(spark.readStream.schema(schema).parquet(source))
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def upsert_new(stream: DataFrame, target: str, checkpoint: str, save: Callable[[DataFrame, str], None] | None = None) -> None:
    """Write each batch of ``stream`` to a folder of its own below ``target``, ``batch=N``, then stop when what is there has been processed.

    A batch that ran before, but whose end the checkpoint doesn't know since the run was killed, has the same number and rows, and overwrites
    its folder: whatever was written of it is written once. ``save`` (batch, folder) writes otherwise than as Parquet; it must overwrite.
    """

    def parquet(batch: DataFrame, folder: str) -> None:
        batch.write.mode("overwrite").parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        (save or parquet)(batch, f"{target.rstrip('/')}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """Of each key the row of the last batch that has it, of several rows there the largest; without the batch's number.

    A null key is a key; maps, which have no order, aren't among the columns. The aggregation combines within tasks first, so that a key's earlier versions aren't shuffled.
    """
    rows = spark.read.parquet(target)
    columns = [c for c in rows.columns if c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max(F.struct(F.col("batch").cast("long").alias("batch"), *[c for c in columns if c not in keys])).alias("last"))
    return newest.select(*[c if c in keys else F.col(f"last.{c}").alias(c) for c in columns])
