"""Reuse by content: results of movies whose inputs haven't changed stay, the others are derived anew and replace their partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.documents import staged

MARKS = "_fingerprints"


def fingerprints(inputs: dict[str, DataFrame], key: str = "movie_id") -> DataFrame:
    """key, print: what a movie's rows in all inputs are, whatever their order. Rows without a key belong to none.

    Two 64-bit hashes of each row with its input's name are added up and mixed by exclusive or, beside the number of rows; all combine within tasks.
    """
    rows = []
    for name, df in sorted(inputs.items()):
        text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
        rows.append(df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), F.xxhash64(F.lit(name), text).alias("a"), F.xxhash64(text, F.lit(name), F.lit(1)).alias("b")))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string")
    return reduce(DataFrame.unionByName, rows).groupBy(key).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), wide("a"), wide("b"), F.bit_xor("a").cast("string"), F.bit_xor("b").cast("string")).alias("print"))


def _stored(spark: SparkSession, target: str, key: str) -> DataFrame:
    try:
        return spark.read.schema(f"{key} string, print string").parquet(f"{target}/{MARKS}")
    except AnalysisException:
        return spark.createDataFrame([], f"{key} string, print string")


def refresh(inputs: dict[str, DataFrame], make: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], target: str, key: str = "movie_id", force: bool = False) -> int:
    """Bring the tables of ``make`` below ``target``, partitioned by ``key``, up to the inputs; how many movies were derived.

    Only movies with another fingerprint than stored are handed to ``make``; a movie that has gone, or has rows no more in a table, loses its partitions there. The
    fingerprints are replaced last: a run that is killed before is done again by the next one. Movies that nothing changed are neither read beyond their inputs nor written.
    """
    spark = next(iter(inputs.values())).sparkSession
    now = staged(fingerprints(inputs, key), "fingerprints")
    old = staged(_stored(spark, target, key), "fingerprints-before")
    same = now.join(old, [key, "print"]).select(key)
    changed = now.select(key) if force else now.select(key).join(same, key, "left_anti")
    changed = staged(changed, "changed")
    gone = old.select(key).join(now.select(key), key, "left_anti")
    n = changed.count()
    if n:
        mine = {name: df.where(F.col(key).isNotNull()).join(changed.select(F.col(key).alias("_key")), F.col(key).cast("string") == F.col("_key"), "left_semi") for name, df in inputs.items()}
        for name, df in make(mine).items():
            own = staged(df.withColumn(key, F.col(key).cast("string")), f"new-{name}")
            own.hint("rebalance", F.col(key)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(f"{target}/{name}")
            _drop(spark, f"{target}/{name}", key, changed.join(own.select(key).distinct(), key, "left_anti"))
            _drop(spark, f"{target}/{name}", key, gone)
    elif not gone.isEmpty():
        for folder in _folders(spark, target):
            _drop(spark, f"{target}/{folder}", key, gone)
    if n or not gone.isEmpty():
        # Beside the old table, then in its place.
        aside = f"{target}/{MARKS}-{uuid.uuid4().hex}"
        now.write.parquet(aside)
        files, path = _files(spark, target)
        files.delete(path(f"{target}/{MARKS}"), True)
        files.rename(path(aside), path(f"{target}/{MARKS}"))
    return n


def _files(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(target).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _folders(spark: SparkSession, target: str) -> list[str]:
    files, path = _files(spark, target)
    return [name for x in files.listStatus(path(target)) if x.isDirectory() and not (name := x.getPath().getName()).startswith("_")]


def _drop(spark: SparkSession, table: str, key: str, keys: DataFrame) -> None:
    """Remove the partitions of keys, a few at a time; there are as many as movies that lost all rows."""
    files, path = _files(spark, table)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in keys.toLocalIterator():
        files.delete(path(f"{table}/{key}={escape(r[0])}"), True)
