"""Subtitle files as a data source: ``spark.read.format("srt")`` gives cues, ``df.write.format("srt")`` one file for each movie.

Files are reached through pyarrow's file systems, by URI or local path. A reading task takes some files; a writing task writes to a
temporary folder below the target, the driver moves the files when all tasks have ended, and removes them when one has failed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "movie_id string, idx int, start_seconds double, end_seconds double, text string"
#: Bytes of files that a reading task takes.
SHARE = 16 << 20
TEMPORARY = "_temporary"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path there."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return fs.LocalFileSystem(), path


def decoded(raw: bytes) -> str:
    """By UTF-8 without its mark, else cp1252, else Latin-1, which reads anything."""
    for name in ("utf-8-sig", "cp1252"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def _seconds(text: str) -> float:
    parts = text.strip().replace(",", ".").split()[:1]
    numbers = parts[0].split(":") if parts else []
    if not 1 <= len(numbers) <= 3:
        return 0.0
    try:
        return round(sum(float(x) * 60**k for k, x in enumerate(reversed(numbers))), 3)
    except ValueError:
        return 0.0


def cues(content: str) -> Iterator[tuple[float, float, str]]:
    """(start, end, text) of the blocks that have a time line and a text, and don't end before they start."""
    for block in re.split(r"\n\s*\n", content.replace("\r\n", "\n").replace("\r", "\n").strip()):
        lines = [x for x in map(str.strip, block.split("\n")) if x]
        at = next((k for k, x in enumerate(lines) if "-->" in x), None)
        if at is None or lines[at].count("-->") != 1:
            continue
        start, end = map(_seconds, lines[at].split("-->"))
        text = " ".join(lines[at + 1 :])
        if text and end >= start:
            yield start, end, text


def _clock(seconds: float) -> str:
    ms = int(seconds * 1000 + 0.5)
    return f"{ms // 3_600_000:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d}"


@dataclass
class Files(InputPartition):
    """Paths of a task; the mover of partitions wants a value."""

    paths: list[str] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(self.paths)


class Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Files]:
        """Files in the order of their names, a task's share at a time; a single file may be named itself."""
        system, at = located(self.path)
        info = system.get_file_info(at)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else [x for x in system.get_file_info(fs.FileSelector(at)) if x.is_file and x.extension.lower() == "srt"]
        tasks, size = [], SHARE
        for x in sorted(found, key=lambda x: x.path):
            if size >= SHARE:
                tasks.append(Files([]))
                size = 0
            tasks[-1].paths.append(x.path)
            size += x.size
        return tasks or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = located(self.path)
        for path in partition.paths:
            with system.open_input_stream(path) as file:
                content = decoded(file.read())
            movie = unquote(path.rsplit("/", 1)[-1].removesuffix(".srt"))
            for idx, (start, end, text) in enumerate(cues(content), 1):
                yield movie, idx, start, end, text


@dataclass
class Written(WriterCommitMessage):
    paths: list[tuple[str, str]]


class Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"{located(self.path)[1].rstrip('/')}/{TEMPORARY}/{self.run}"

    def write(self, iterator: Iterator) -> Written:
        """Rows of a movie follow one another, as ``write_srt`` sees to; only the movie at hand is open."""
        system, target = located(self.path)
        mine, movie, file, n, out, done = f"{self.folder}/{uuid.uuid4().hex}", object(), None, 0, [], set()
        system.create_dir(mine)
        for row in iterator:
            if row["movie_id"] != movie:
                movie, n = row["movie_id"], 0
                if movie in done:
                    raise ValueError(f"rows of {movie} don't follow one another")
                done.add(movie)
                if file:
                    file.close()
                name = f"{quote(str(movie), safe='')}.srt"
                file = system.open_output_stream(f"{mine}/{name}")
                out.append((f"{mine}/{name}", f"{target.rstrip('/')}/{name}"))
            n += 1
            text = "\n" * (n > 1) + f"{n}\n{_clock(row['start_seconds'])} --> {_clock(row['end_seconds'])}\n{row['text']}\n"
            file.write(text.encode())
        if file:
            file.close()
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        system, target = located(self.path)
        moves = [x for m in messages if m for x in m.paths]
        if self.overwrite:
            kept = {to for _, to in moves}
            for x in system.get_file_info(fs.FileSelector(target, allow_not_found=True)):
                if x.is_file and x.extension == "srt" and x.path not in kept:
                    system.delete_file(x.path)
        for made, to in moves:
            system.move(made, to)
        system.delete_dir(self.folder)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = located(self.path)
        if system.get_file_info(self.folder).type != fs.FileType.NotFound:
            system.delete_dir(self.folder)


class Srt(DataSource):
    @classmethod
    def name(cls) -> str:
        return "srt"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(Srt)


def write_srt(cues: DataFrame, path: str, overwrite: bool = True) -> None:
    """One file for each movie of cues (movie_id, idx, start_seconds, end_seconds, text), numbered in the order of idx.

    A movie's cues are one task's, which writes them as they come. Without ``overwrite`` other movies' files stay. Names are the ids with what
    a path can't hold quoted. A null movie has no file, a null time counts as 0, a null text as empty.
    """
    register(cues.sparkSession)
    rows = cues.where("movie_id IS NOT NULL").selectExpr("cast(movie_id AS string) AS movie_id", "cast(idx AS int) AS idx", "coalesce(start_seconds, 0D) AS start_seconds", "coalesce(end_seconds, 0D) AS end_seconds", "coalesce(text, '') AS text")
    rows.repartition("movie_id").sortWithinPartitions("movie_id", "idx", "start_seconds").write.format("srt").mode("overwrite" if overwrite else "append").save(path)


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("srt").load(path)
