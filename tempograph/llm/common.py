"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import string
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset, a local session gets a folder of its own; on a cluster it must be set, since a folder of one machine loses rows.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{tempfile.gettempdir()}/tempograph-checkpoints"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back.

    Unlike localCheckpoint the copy survives the loss of executors. The caller removes it by ``drop`` once nothing reads it any more, or
    all of an application's copies by ``drop_stored``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop(*frames: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in frames:
        _remove(df.sparkSession, df.stored_at)


def drop_stored(spark: SparkSession) -> None:
    """Remove all that this application has stored; results that weren't written yet can't be read after it."""
    _remove(spark, shared_dir(spark))


#: Rows of ids or digests that may be broadcast, some 100 bytes each; beyond, a shuffled join does it.
SMALL = 500_000


def few(keys: DataFrame) -> DataFrame:
    """A stored table of keys, to be broadcast if counted to be small."""
    return F.broadcast(keys) if keys.count() <= SMALL else keys


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast ``lower``."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, mod 5, is 0. A null id counts as an empty one."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


#: Rows of the slices of Arrow batches that Python works on at a time.
FRAME = 500


def slices(batches, rows: int = FRAME):
    """Slices of record batches, so that a worker holds the results of few rows at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def pieces(raw: bytes, span: int = 1 << 20):
    """The runs of a text, each of about ``span`` bytes, cut before a space; a word is never cut."""
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + span)
        end = len(raw) if end < 0 else end
        yield raw[start:end]
        start = end


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def in_frames(df: DataFrame, function, schema: str | StructType, rows: int = FRAME) -> DataFrame:
    """``mapInArrow`` for texts: ``function`` gets slices of at most ``rows`` rows and yields record batches or dicts of columns.

    Columns stay Arrow, so a null beside an id never turns ids to floats. Freed memory goes back at the end of a task, since idle workers
    live on beside the next stage.
    """
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    fields = to_arrow_schema(kind)

    def run(batches):
        for out in function(slices(batches, rows)):
            yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_arrays([c if isinstance(c := out[f.name], pa.Array) else pa.array(c, f.type) for f in fields], schema=fields)
        give_back()

    return df.mapInArrow(run, kind)


def per_worker(key: str, make):
    """A value that the tasks of one Python worker share, in a module of its own as functions come by value for each task."""
    values = sys.modules.setdefault("tempograph_worker_values", types.ModuleType("tempograph_worker_values")).__dict__
    if key not in values:
        values[key] = make()
    return values[key]


def salted_to(many: DataFrame, one: DataFrame, key: str, spread: Column, salts: int = 64) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has a row at most for each key, with no task getting all rows of a frequent key.

    Rows of ``many`` are dealt over ``salts`` by ``spread``; each row of ``one`` is copied to the salts that its key has, known from a
    partially aggregated bit mask, so a rare key is copied once.
    """
    marked = many.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    masks = marked.groupBy(key).agg(F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"))
    return marked.join(one.join(masks, key).withColumn("salt", spread_out(salts)).drop("mask"), [key, "salt"]).drop("salt")


def spread_out(salts: int = 64) -> Column:
    """One row for each salt in a mask."""
    return F.explode(F.expr(f"filter(sequence(0, {salts - 1}), s -> shiftrightunsigned(mask, s) & 1 = 1)"))


def ranked(df: DataFrame, order: list[Column], group: list[str], name: str) -> DataFrame:
    """``df`` with ``rank`` (long, from 1) by ``order`` within ``group``, with no task getting more than a range of the rows.

    Rows are dealt by range and stored with their range's number; a prefix sum over the ranges' counts, one small row for each range and
    group, gives each range its base. The stored table is left for the result to read.
    """
    cut = stored(df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("part", F.spark_partition_id()), name)
    counts = cut.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*group, "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"))
    numbered = cut.withColumn("place", F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order)))
    return numbered.join(F.broadcast(bases), [*group, "part"]).withColumn("rank", F.col("base") + F.col("place")).drop("part", "base", "place")
