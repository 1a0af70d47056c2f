"""Command line: derive the stages of a folder of events, characters, appearances and movies (Parquet tables or JSON lines)."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .plans import phases
from .sources.documents import DocumentError, document_error, in_file_order, write_documents

#: Schemas of the inputs; JSON is read by these, never inferred. The first is the main input.
INPUTS = {
    "events": "movie_id string, event int, sec double, location string, action string, labels array<string>, summary string, dialogue array<string>, sig int, uncertainty string",
    "characters": "movie_id string, character_id string, name string, first_seen double, last_seen double",
    "appearances": "movie_id string, character_id string, ord int, event int, sec double",
    "movies": "movie_id string, samples int, duration double",
}
MAIN = next(iter(INPUTS))


def load(spark: SparkSession, source: str, name: str, kind: str) -> DataFrame:
    """An input with its rows' positions. The main input must be there and whole; others count as empty where they are missing, and lines of theirs that can't be read go."""
    path, schema = f"{source}/{name}", INPUTS[name]
    try:
        if kind == "parquet":
            return in_file_order(spark.read.schema(schema).parquet(path))
        lines = in_file_order(spark.read.text(path)).withColumn("error", document_error(F.col("value"))).where("trim(value) <> ''")
    except AnalysisException as error:
        if name == MAIN:
            raise DocumentError(f"{path}: not found", missing=True) from error
        return spark.createDataFrame([], StructType.fromDDL(schema)).withColumn("pos", F.lit(None).cast("long"))
    if name == MAIN and (bad := lines.where("error IS NOT NULL").select("pos.file", "error").first()):
        raise DocumentError(f"{bad['file']}: {bad['error']}")
    return lines.where("error IS NULL").select(F.from_json("value", schema).alias("d"), "pos").select("d.*", "pos")


def main(arguments: list[str] | None = None) -> int:
    """0 when done; 2 when the main input is missing, 3 when the output is there without ``--force`` or ``--resume``, 4 when the main input can't be read, 5 when a phase has failed."""
    parser = argparse.ArgumentParser(prog="tempograph", description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--format", choices=["json", "parquet"], default="json")
    parser.add_argument("--phase", action="append", choices=list(phases.PHASES), help="only this phase and what it needs; may be repeated")
    parser.add_argument("--gap", type=float, default=180.0, help="seconds between events that end a scene")
    parser.add_argument("--expand", action="store_true", help="a clip for each event")
    parser.add_argument("--freezes", type=int, default=0)
    parser.add_argument("--force", action="store_true", help="overwrite what is there")
    parser.add_argument("--resume", action="store_true", help="run what is missing in a target that is there")
    parser.add_argument("--dry-run", action="store_true", help="count the rows of each stage and write nothing to the target")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tempograph").getOrCreate()
    try:
        tables = {name: load(spark, args.source, name, args.format) for name in INPUTS}
    except DocumentError as error:
        print(error, file=sys.stderr)
        return 2 if error.missing else 4
    target = spark._jvm.org.apache.hadoop.fs.Path(args.target)
    if not (args.force or args.resume or args.dry_run) and target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        print(f"{args.target} is there; --force overwrites it, --resume goes on", file=sys.stderr)
        return 3
    as_json = args.format == "json"
    inner = f"{args.target.rstrip('/')}/_phases" if as_json else args.target.rstrip("/")
    records = phases.run(spark, tables, inner, args.phase, phases.Options(args.gap, args.expand, args.freezes), args.force, args.dry_run)
    for r in records:
        if args.dry_run or r["error"]:
            print(r["phase"], r["rows"] if r["error"] is None else f"{r['status']}: {r['error']}", file=sys.stderr if r["error"] else sys.stdout)
    if phases.failed(records):
        return 5
    if as_json and not args.dry_run:
        for r in records:
            if phases.PHASES[r["phase"]].shown and r["status"] == "SUCCESS":
                write_documents(spark.read.parquet(f"{inner}/{r['phase']}"), f"{args.target.rstrip('/')}/{r['phase']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
