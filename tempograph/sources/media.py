"""Media facts from the JSON that a container probe prints, and the subtitles that lie beside a movie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .documents import document_error

PROBE = (
    "struct<format:struct<format_name:string,duration:string,tags:map<string,string>>,streams:array<struct<index:int,codec_type:string,codec_name:string,"
    "width:int,height:int,r_frame_rate:string,avg_frame_rate:string,channels:int,sample_rate:string,tags:map<string,string>,disposition:map<string,int>>>>"
)
EXTENSIONS = (".srt", ".vtt", ".ass", ".ssa")


def _kind(name: str) -> Column:
    return F.filter(F.coalesce("p.streams", F.array().cast(PROBE[PROBE.index("streams:") + 8 : -1])), lambda s: s["codec_type"] == name)


def shape_metadata(probes: DataFrame, keep: list[str] = ("movie_id",), probe: str = "probe") -> DataFrame:
    """One row for each probe. What is missing or unreadable takes its default: 0, ``unknown``, null or an empty array."""
    df = probes.select(*keep, F.from_json(probe, PROBE).alias("p")).select(*keep, "p", *[_kind(k).alias(f"_{k}") for k in ("video", "audio", "subtitle")])
    v, a = F.get("_video", F.lit(0)), F.get("_audio", F.lit(0))
    width, height = F.coalesce(v["width"], F.lit(0)), F.coalesce(v["height"], F.lit(0))
    rate = S.parse_fps(v["r_frame_rate"])
    language = lambda s: F.coalesce(F.try_element_at(s["tags"], F.lit("language")), F.lit("und"))
    flag = lambda s, k: F.coalesce(F.try_element_at(s["disposition"], F.lit(k)), F.lit(0)) != 0
    track = lambda s: F.struct(
        F.coalesce(s["index"], F.lit(0)).alias("stream_index"), F.coalesce(s["codec_name"], F.lit("unknown")).alias("codec_name"), language(s).alias("language"),
        F.try_element_at(s["tags"], F.lit("title")).alias("title"), flag(s, "default").alias("is_default"), flag(s, "forced").alias("is_forced"),
    )
    return df.select(
        *keep,
        F.coalesce("p.format.format_name", F.lit("unknown")).alias("container_format"),
        F.coalesce(F.round(F.col("p.format.duration").try_cast("double"), 3), F.lit(0.0)).alias("duration_seconds"),
        width.alias("width"),
        height.alias("height"),
        F.when((width != 0) & (height != 0), F.concat_ws("x", width, height)).otherwise("unknown").alias("resolution"),
        F.when(rate != 0, rate).otherwise(S.parse_fps(v["avg_frame_rate"])).alias("fps"),
        v["codec_name"].alias("video_codec"),
        a["codec_name"].alias("audio_codec"),
        F.coalesce(a["channels"], F.lit(0)).alias("audio_channel_count"),
        a["sample_rate"].try_cast("int").alias("audio_sample_rate"),
        *[F.size(f"_{k}").alias(f"number_of_{k}_streams") for k in ("video", "audio", "subtitle")],
        F.array_distinct(F.filter(F.transform("_subtitle", language), lambda x: x != "und")).alias("subtitle_languages"),
        F.transform("_subtitle", track).alias("subtitle_tracks"),
        F.try_element_at("p.format.tags", F.lit("creation_time")).alias("media_created_at"),
    )


#: Codecs of subtitles that are texts, and the languages preferred, in order.
TEXT_CODECS = ["subrip", "srt", "webvtt", "vtt", "ass", "ssa", "mov_text", "text"]
PREFERRED = ["eng", "en", "msa", "ms", "zho", "zh"]


def check_probes(probes: DataFrame, probe: str = "probe") -> tuple[DataFrame, DataFrame]:
    """Probes that can be shaped, and the others with ``error``: empty, malformed, no object, or no format."""
    why = F.coalesce(document_error(F.col(probe)), F.when(F.get_json_object(probe, "$.format").isNull(), "no format"))
    marked = probes.withColumn("error", why)
    return marked.where("error IS NULL").drop("error"), marked.where("error IS NOT NULL")


def choose_subtitle(tracks: DataFrame, keys: list[str], index: Column | None = None, language: Column | None = None, preferred: list[str] = PREFERRED, codecs: list[str] = TEXT_CODECS) -> DataFrame:
    """Of each movie the subtitle track to take, with ``rule``; a movie without a fitting one has no row.

    tracks: keys, pos (the order in the movie), stream_index, codec_name, language, is_default. Rules: 1 the stream ``index`` asked for, of whatever codec, or none at all;
    then of the text codecs only 2 the first of the ``language`` asked for, or one that begins with it; 3 the first default track; 4 the first of the
    first preferred language that there is; 5 the first. What is asked for is a column, null or blank where nothing is. Nulls of a track meet no rule.
    """
    asked = F.lit(None).cast("int") if index is None else index
    wish = F.nullif(F.lower(F.trim(F.lit(None).cast("string") if language is None else language)), F.lit(""))
    own = F.lower(F.coalesce("language", F.lit("")))
    text = F.coalesce(F.lower("codec_name").isin(codecs), F.lit(False))
    first = F.lit(None).cast("int")
    for place, p in reversed(list(enumerate(preferred))):
        first = F.when(own.startswith(p), place).otherwise(first)
    by_text = F.when(F.coalesce(own.startswith(wish), F.lit(False)), 2).when(F.coalesce("is_default", F.lit(False)), 3).when(first.isNotNull(), 4).otherwise(5)
    rule = F.when(asked.isNotNull(), F.when(F.col("stream_index") == asked, 1)).when(text, by_text)
    ranked = tracks.withColumns({"rule": rule, "_f": F.when(rule == 4, first).otherwise(0)}).where("rule IS NOT NULL")
    best = ranked.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in ranked.columns if c not in (*keys, "_f")]), F.struct("rule", "_f", "pos")).alias("b"))
    return best.select(*keys, "b.*")


def discover_subtitles(movies: DataFrame, files: DataFrame, shared: str) -> DataFrame:
    """Subtitles of each movie, best first: movie_id, path, place from 1.

    movies: movie_id, path. files: path. Beside the movie count its stem and its stem with a language; in
    the folder ``shared`` all that begins with the stem or the id. Extensions go in the order of EXTENSIONS. Repeated
    files count once; a movie without a path has those of its id; null paths of files are none.
    """
    split = lambda df: df.withColumns({"folder": F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "file": F.regexp_extract("path", r"([^/]+)$", 1)})
    m = split(movies).select("movie_id", "folder", F.regexp_replace("file", r"(?<=.)\.[^.]*$", "").alias("stem"))
    f = split(files).withColumn("ext", F.lower(F.regexp_extract("file", r"(\.[^.]+)$", 1))).where(F.col("ext").isin(*EXTENSIONS))
    f = f.withColumns({"name": F.expr("left(file, length(file) - length(ext))"), "e": F.array_position(F.array(*map(F.lit, EXTENSIONS)), F.col("ext"))})
    beside = f.join(m.withColumnRenamed("folder", "_f"), (F.col("folder") == F.col("_f")) & (F.split_part("name", F.lit("."), F.lit(1)) == F.split_part("stem", F.lit("."), F.lit(1))))
    beside = beside.where((F.col("name") == F.col("stem")) | F.col("name").startswith(F.concat("stem", F.lit("."))))
    beside = beside.select("movie_id", "path", F.struct(F.lit(0).alias("where"), F.col("e").alias("e"), (F.col("name") != F.col("stem")).cast("int").alias("tagged"), "path").alias("rank"))
    # A name begins with a stem: each name meets the stems that equal one of its prefixes, so that the join has an equal key.
    prefixes = f.where(F.col("folder") == shared).select("path", "name", "e", F.explode(F.transform(F.sequence(F.lit(1), F.length("name")), lambda n: F.substring("name", F.lit(1), n))).alias("stem"))
    stems = m.select("movie_id", F.explode(F.array(F.struct(F.lit(1).alias("where"), F.col("stem").alias("stem")), F.struct(F.lit(2).alias("where"), F.col("movie_id").alias("stem")))).alias("s")).select("movie_id", "s.*").where("stem <> ''")
    common = prefixes.join(stems, "stem").select("movie_id", "path", F.struct("where", "e", F.lit(0).alias("tagged"), "path").alias("rank"))
    best = beside.unionByName(common).groupBy("movie_id", "path").agg(F.min("rank").alias("rank"))
    return best.select("movie_id", "path", F.row_number().over(Window.partitionBy("movie_id").orderBy("rank")).alias("place"))
