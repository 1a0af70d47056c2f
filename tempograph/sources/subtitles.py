"""Subtitle readers and writer: SRT, WebVTT and ASS from one text per movie (movie_id, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import BLANK, clean_text, format_srt_time, format_timestamp, parse_timestamp, strip, vtt_speaker
from .documents import empty_files

#: What begins a WebVTT block that is no cue, and the columns of an ASS event without a Format line.
HEADS = ["WEBVTT", "NOTE", "STYLE"]
ASS_FIELDS = ["layer", "start", "end", "style", "name", "marginl", "marginr", "marginv", "effect", "text"]

#: The bytes from 0x80 that cp1252 has a letter for, read as Latin-1, and those letters; the others have none.
DEFINED = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "replace") != "\ufffd"]
CONTROLS, LETTERS = bytes(DEFINED).decode("latin-1"), bytes(DEFINED).decode("cp1252")
UNDEFINED = "".join(f"\\u{b:04X}" for b in range(0x80, 0xA0) if b not in DEFINED)


def decoded(content: Column) -> Column:
    """struct(text, encoding) of bytes: UTF-8 where they are valid, without its mark; else cp1252, or Latin-1 where a byte has no letter there."""
    utf, latin = content.cast("string"), F.decode(content, "ISO-8859-1")
    read = lambda text, name: F.struct(text.alias("text"), F.lit(name).alias("encoding"))
    single = F.when(latin.rlike(f"[{UNDEFINED}]"), read(latin, "latin-1")).otherwise(read(F.translate(latin, CONTROLS, LETTERS), "cp1252"))
    return F.when(F.is_valid_utf8(utf), read(F.regexp_replace(utf, "^\\uFEFF", ""), "utf-8")).otherwise(single)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """movie_id (path), content, encoding, error: ``empty`` where a file holds no text, else null."""
    none = empty_files(spark, path).select("path", F.lit(b"").alias("content"))
    raw = spark.read.format("binaryFile").load(path).select("path", "content").unionByName(none).select(F.col("path").alias("movie_id"), decoded(F.col("content")).alias("d"))
    return raw.select("movie_id", F.col("d.text").alias("content"), "d.encoding", F.when(F.col("d.text") == "", "empty").alias("error"))


def _finish(cues: DataFrame, order: list[str]) -> DataFrame:
    cues = cues.where("text <> '' and end_seconds >= start_seconds")
    cues = cues.withColumn("idx", F.row_number().over(Window.partitionBy("movie_id").orderBy(*order)))
    return cues.select("movie_id", "idx", "start_seconds", "end_seconds", format_timestamp(F.col("start_seconds")).alias("start"), format_timestamp(F.col("end_seconds")).alias("end"), F.round(F.col("end_seconds") - F.col("start_seconds"), 3).alias("duration_seconds"), "text", "speaker")


def _blocks(docs: DataFrame, vtt: bool) -> DataFrame:
    """Cues of the blocks between blank lines. In WebVTT a block whose first line begins with a word of HEADS is none, whatever follows."""
    blocks = docs.select("movie_id", F.posexplode(F.split(strip(F.regexp_replace("content", r"\r\n?", "\n")), rf"\n{BLANK}*\n")).alias("ord", "block"))
    lines = F.filter(F.transform(F.split("block", "\n"), strip), lambda x: x != "")
    blocks = blocks.withColumn("lines", lines)
    if vtt:
        blocks = blocks.where(~F.coalesce(F.get("lines", F.lit(0)), F.lit("")).rlike(f"^(?:{'|'.join(HEADS)})"))
    blocks = blocks.withColumn("at", F.array_position(F.transform("lines", lambda x: F.contains(x, F.lit("-->"))), True)).where("at > 0")
    sides = F.split(F.get("lines", F.col("at").cast("int") - 1), "-->")
    body = F.array_join(F.slice("lines", F.col("at").cast("int") + 1, F.size("lines")), " ")
    cues = blocks.where(F.size(sides) == 2).select("movie_id", "ord", parse_timestamp(sides[0]).alias("start_seconds"), parse_timestamp(sides[1]).alias("end_seconds"), clean_text(body).alias("text"), (vtt_speaker(body) if vtt else F.lit(None).cast("string")).alias("speaker"))
    return _finish(cues, ["ord"])


def parse_srt(docs: DataFrame) -> DataFrame:
    """movie_id, idx, start_seconds, end_seconds, start, end, duration_seconds, text, speaker (null) of docs (movie_id, content).

    Blocks without a time line, with a text that is empty once cleaned, or that end before they start are left out, and the others numbered. A null or empty content has no
    cues; a movie of several rows is numbered as one.
    """
    return _blocks(docs, vtt=False)


def parse_vtt(docs: DataFrame) -> DataFrame:
    """As ``parse_srt``, with speakers by their voice tags."""
    return _blocks(docs, vtt=True)


def parse_ass(docs: DataFrame) -> DataFrame:
    """Events by the columns of the last Format line, or by ASS_FIELDS where there is none with a text; ordered by start, then line."""
    lines = docs.select("movie_id", F.posexplode(F.split("content", r"\r\n|\r|\n")).alias("ord", "line")).withColumn("line", strip(F.col("line")))
    w = Window.partitionBy("movie_id").orderBy("ord")
    lines = lines.withColumn("section", F.last(F.when(F.col("line").rlike(r"^\[.*\]$"), F.lower("line")), ignorenulls=True).over(w)).where("section = '[events]'")
    fields = F.transform(F.split(F.lower(F.regexp_extract("line", r"(?i)^format:(.*)$", 1)), ","), strip)
    named = F.last(F.when(F.col("line").rlike("(?i)^format:"), fields), ignorenulls=True).over(w)
    usual = F.array(*map(F.lit, ASS_FIELDS))
    lines = lines.withColumn("format", F.when(F.coalesce(F.array_contains(named, "text"), F.lit(False)), named).otherwise(usual)).where(F.col("line").rlike("(?i)^dialogue:"))
    values = F.expr(r"split(regexp_extract(line, '(?i)^dialogue:\\s*(.*)$', 1), ',', size(format))")
    lines = lines.withColumn("values", values)
    field = lambda name: F.try_element_at(F.col("values"), F.array_position("format", name).cast("int"))
    has = F.array_contains("format", "start") & F.array_contains("format", "end")
    speaker = F.when(F.array_contains("format", "name"), F.nullif(strip(field("name")), F.lit("")))
    cues = lines.where(has & (F.size("values") == F.size("format"))).select("movie_id", "ord", parse_timestamp(field("start")).alias("start_seconds"), parse_timestamp(field("end")).alias("end_seconds"), clean_text(field("text")).alias("text"), speaker.alias("speaker"))
    return _finish(cues, ["start_seconds", "ord"])


def parse(files: DataFrame) -> DataFrame:
    """By extension of movie_id, else by content (WEBVTT within the first 200 letters, [events] in any case), else as SRT. Empty files have no cues."""
    name, text = F.lower("movie_id"), F.col("content")
    kind = F.when(name.rlike(r"\.vtt$"), "vtt").when(name.rlike(r"\.(ass|ssa)$"), "ass").when(name.rlike(r"\.srt$"), "srt")
    kind = kind.when(F.contains(F.left(text, F.lit(200)), F.lit("WEBVTT")), "vtt").when(F.contains(F.lower(text), F.lit("[events]")), "ass").otherwise("srt")
    files = files.withColumn("kind", kind)
    return parse_srt(files.where("kind = 'srt'")).unionByName(parse_vtt(files.where("kind = 'vtt'"))).unionByName(parse_ass(files.where("kind = 'ass'")))


def to_srt(cues: DataFrame) -> DataFrame:
    """movie_id, content: the numbered blocks of each movie's cues (idx, start_seconds, end_seconds, text). Cues of one idx go by their block's text; a null text or time leaves out its line."""
    block = F.concat_ws("\n", F.col("idx").cast("string"), F.concat(format_srt_time(F.col("start_seconds")), F.lit(" --> "), format_srt_time(F.col("end_seconds"))), "text")
    return cues.groupBy("movie_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", block.alias("b")))), lambda x: x["b"]), "\n\n").alias("content"))
