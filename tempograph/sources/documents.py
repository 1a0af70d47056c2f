"""Readers of JSON documents, strict or tolerant, with a channel for what can't be read; and the sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class DocumentError(ValueError):
    """A main input that isn't there (``missing``), or that holds documents which can't be read."""

    def __init__(self, message: str, missing: bool = False):
        super().__init__(message)
        self.missing = missing


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row for each document; what can't be read becomes null, never an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """path of the files without content at ``path`` or right below it, which Spark's own readers pass over. The driver lists names, as they do."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x for x in files.listStatus(where) if x.isFile() and x.getLen() == 0] if files.exists(where) else []
    return spark.createDataFrame([(x.getPath().toString(),) for x in found if not x.getPath().getName().startswith(("_", "."))], "path string")


def document_error(text: Column) -> Column:
    """Why a text is no JSON object, or null."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty").when(F.try_parse_json(text).isNull(), "malformed").when(~F.ltrim(F.regexp_replace(text, r"^\s+", "")).startswith("{"), "no object")


def read_checked(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The documents below ``path``, one to a file, and those that can't be read: (path and the schema's columns), (path, error, content).

    A field of another type than the schema's is null and spoils nothing else. Both frames read the files by themselves.
    """
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")).withColumn("error", document_error(F.col("content")))
    good = raw.where("error IS NULL").select("path", F.from_json("content", schema).alias("d")).select("path", "d.*")
    bad = raw.where("error IS NOT NULL").select("path", "error", "content")
    return good, bad.unionByName(empty_files(spark, path).select("path", F.lit("empty").alias("error"), F.lit("").alias("content")))


def require(bad: DataFrame, most: int = 5) -> None:
    """Stop if there are unreadable documents, naming ``most`` of them."""
    if found := bad.select("path", "error").limit(most).collect():
        raise DocumentError("; ".join(f"{r['path']}: {r['error']}" for r in found))


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The documents of a main input. One that can't be read stops the run, with its path."""
    try:
        good, bad = read_checked(spark, path, schema)
    except AnalysisException as error:
        raise DocumentError(f"{path}: not found", missing=True) from error
    require(bad)
    return good


def read_tolerant(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """As ``read_checked``; an input that isn't there is empty."""
    try:
        return read_checked(spark, path, schema)
    except AnalysisException:
        kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        return spark.createDataFrame([], StructType.fromDDL("path string").add("d", kind)).select("path", "d.*"), spark.createDataFrame([], "path string, error string, content string")


def elements(df: DataFrame, array_json: str, keep: list[str] = ()) -> DataFrame:
    """The objects of a JSON array with their places; other elements go, a bad field spoils only itself."""
    each = F.from_json(array_json, "array<string>")
    return df.select(*keep, F.posexplode(each).alias("pos", "element")).where(F.trim("element").startswith("{"))


def in_file_order(df: DataFrame, name: str = "pos") -> DataFrame:
    """A table as read from files, with each row's position: rows of a file keep its order, files follow by path.

    Only for a frame straight from a file source. Positions compare; they aren't consecutive.
    """
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias(name))


def field(json: Column, path: str, kind: str, default) -> Column:
    """A field of a JSON text, with a default where the text, the field or its type is bad."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(json), path, kind), F.lit(default).cast(kind))


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def shared_folder(spark: SparkSession) -> str:
    """The application's folder below ``spark.checkpoint.dir``. A local session without that setting gets a folder of its own, a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{tempfile.gettempdir()}/tempograph-stages"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """A stage's output as a Parquet table in the folder that driver and executors share, read back: later stages that use it several times compute it once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
