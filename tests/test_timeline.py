"""Unit vectors of the functions and operators, and all queries against their SQL."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tempograph.functions import rules as R
from tempograph.functions import scalars as S
from tempograph.operators import identity as D
from tempograph.operators import intervals as I
from tempograph.operators import timeline as T
from tempograph.operators.packing import pack_clips
from tempograph.plans import catalogue
from tempograph.sources import documents, media, subtitles
from tempograph.streaming.incremental import process_new

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: S.format_timestamp(F.lit(65.5)), "00:01:05.500"),
        (lambda: S.format_timestamp(F.lit(3661.125)), "01:01:01.125"),
        (lambda: S.format_timestamp(F.lit(-1.0)), "00:00:00.000"),
        (lambda: S.format_srt_time(F.lit(65.45)), "00:01:05,450"),
        (lambda: S.parse_timestamp(F.lit("00:01:05,450 x")), 65.45),
        (lambda: S.parse_timestamp(F.lit("01:05.5")), 65.5),
        (lambda: S.parse_timestamp(F.lit("junk")), 0.0),
        (lambda: S.file_size(F.lit(500)), "500 B"),
        (lambda: S.file_size(F.lit(1024)), "1.00 KB"),
        (lambda: S.file_size(F.lit(1048576)), "1.00 MB"),
        (lambda: S.parse_fps(F.lit("30000/1001")), 29.97),
        (lambda: S.parse_fps(F.lit("0/0")), 0.0),
        (lambda: S.parse_fps(F.lit(None).cast("string")), 0.0),
        (lambda: S.sanitize_id(F.lit("My Great Movie (2024).mp4")), "my_great_movie_2024"),
        (lambda: S.sanitize_id(F.lit("")), "unnamed_movie"),
        (lambda: S.filename_language(F.lit("movie.en.srt")), "en"),
        (lambda: S.filename_language(F.lit("Movie.srt")), "und"),
        (lambda: S.clean_text(F.lit("<b>Hi</b>\\N{\\an8}you\n now")), "Hi you now"),
        (lambda: S.gender(F.lit("tall woman")), "female"),
        (lambda: S.gender(F.lit("tall woman"), legacy=True), "male"),
        (lambda: S.padded_id("SCENE", F.lit(1234)), "SCENE_1234"),
        (lambda: S.normalize_location(F.lit("A dark Forest")), "dark forest / lakeshore"),
        (lambda: S.compatible_locations(F.lit("rainy pavement"), F.lit("a boat")), True),
        (lambda: S.wrap_caption(F.lit("one two three four"), 8), "one two\nthree four"),
        (lambda: T.coverage(F.lit(10), F.lit(100), F.lit(0.0), F.lit(0.0)), "PARTIAL"),
        (lambda: T.coverage(F.lit(3), F.lit(3), F.lit(0.0), F.lit(0.0)), "COMPLETE"),
    ],
)
def test_scalars(spark, column, want):
    assert one(spark, column()) == want


def test_grid_and_cues(spark):
    spans = spark.createDataFrame([(1, 10.0), (2, 9.0), (3, 0.0)], "movie_id long, duration double")
    assert [r["t"] for r in I.time_grid(spans, 2.0).where("movie_id = 1").orderBy("k").collect()] == [0, 2, 4, 6, 8, 10]
    assert I.time_grid(spans, 3.0).where("movie_id = 2").count() == 4 and I.time_grid(spans, 3.0).where("movie_id = 3").count() == 1
    cues = spark.createDataFrame([(1, 1.0, 2.5), (2, 5.0, 6.5), (3, 10.0, 12.0)], "cue long, rs double, re double")
    for t, w, n in ((2.0, 1.5, 1), (4.0, 1.5, 2), (8.0, 1.0, 0)):
        assert len(I.match_cues(spark.createDataFrame([(1, t)], "id long, t double"), cues, w, bucket=2.0).first()["cues"]) == n


def test_packing_and_validation(spark):
    events = spark.createDataFrame([(1, k, 3.0 * k, 600.0) for k in range(4)], "movie_id long, ord int, t double, movie_end double")
    assert [r["start"] for r in pack_clips(events).orderBy("ord").collect()] == [0, 5, 10, 15]
    kinds = "movie_id long, idx int, clip_id string, start double, stop double, duration double, event int, scene string, reason string, movie_end double, pushed boolean"
    clip = spark.createDataFrame([(1, 1, "a", -1.0, 9.0, 10.0, 1, "s", "r", 600.0, None)], kinds)
    assert T.validate_clips(clip).first()["errors"] == ["too_long", "negative_start"]
    # The second of two alike ids; touching is wrong unless either clip was pushed; overlap always is.
    rows = [(1, "a", 0.0, False), (2, "a", 3.2, False), (3, None, 6.3, True), (4, None, 9.4, None), (5, "b", 12.0, True), (6, "c", 17.0, False), (7, "d", 22.0, False)]
    checked = T.validate_clips(spark.createDataFrame([(1, i, x, t, t + 3, 3.0, 1, "s", "r", None, p) for i, x, t, p in rows], kinds))
    got = {r["idx"]: (r["errors"], r["warnings"]) for r in checked.collect()}
    assert got == {1: ([], []), 2: (["duplicate_id", "touching"], []), 3: (["empty_id"], []), 4: (["empty_id"], []), 5: (["overlap"], []), 6: ([], []), 7: ([], ["close"])}
    plans = spark.createDataFrame([(1, 7), (2, 3), (3, 0), (4, None)], "movie_id long, total_clips int")
    assert sorted(tuple(r) for r in T.validate_plans(plans, checked).collect()) == [(1, 5, 1, False), (2, 1, 0, False), (3, 0, 0, True), (4, 0, 0, True)]


def test_edges(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 1, "b"), (2, 1, "c"), (2, 2, "a"), (2, 2, None)], "movie_id long, event int, who string")
    assert sorted(tuple(r) for r in T.edges(df, "event", "who", ("movie_id",)).collect()) == [(1, "a", "b", 1), (1, "b", "a", 1)]


def test_names_and_documents(spark):
    assert one(spark, S.candidate_names(F.lit("Hello, Anna Smith. i am tired"))) == ["Anna Smith", "tired"]
    df = spark.createDataFrame([('[{"a": 1}, 5, {"a": "x"}]',)], "j string")
    got = documents.elements(df, "j").select("pos", documents.field(F.col("element"), "$.a", "int", -1).alias("a")).collect()
    assert [tuple(r) for r in got] == [(0, 1), (2, -1)]


def test_subtitles(spark):
    srt = "1\n00:00:01,000 --> 00:00:02,500\n<b>Hi</b>\n\n2\n00:00:05,000 --> 00:00:04,000\nbad\n"
    vtt = "WEBVTT\n\nNOTE x\n\n00:01.000 --> 00:02.000 align:start\n<v Bob>Hello\n"
    ass = "[Events]\nFormat: Layer, Start, End, Name, Text\nDialogue: 0,0:00:05.00,0:00:06.00,Al,b, c\nDialogue: 0,0:00:01.00,0:00:02.00,,{\\pos(1,2)}a\\Nz\n"
    files = spark.createDataFrame([("a.srt", srt), ("b.vtt", vtt), ("c", ass)], "movie_id string, content string")
    got = [(r["movie_id"], r["idx"], r["start_seconds"], r["text"], r["speaker"]) for r in subtitles.parse(files).orderBy("movie_id", "idx").collect()]
    assert got == [("a.srt", 1, 1.0, "Hi", None), ("b.vtt", 1, 1.0, "Hello", "Bob"), ("c", 1, 1.0, "a z", None), ("c", 2, 5.0, "b, c", "Al")]


def test_incremental(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    for k in range(2):
        spark.range(k * 3, k * 3 + 3).write.mode("append").parquet(src)
        process_new(spark, src, spark.range(1).schema, lambda df: df, out, mark)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(6))


def test_rules(spark):
    assert one(spark, R.scene_function(F.lit("A NIGHTCLUB, dancing"), F.lit(9), F.lit(True))) == "INTRODUCTION"
    assert one(spark, R.scene_function(F.lit(None).cast("string"), F.lit(7), F.lit(True))) == "ESCALATION"
    assert tuple(one(spark, R.purpose(F.lit("x"), F.array(F.lit("DISCOVERY"), F.lit("SETUP"))))) == ("opening_hook_and_audio_discovery", "none")
    assert tuple(one(spark, R.purpose(F.lit(None).cast("string"), F.lit(None).cast("array<string>")))) == ("story_progression", "none")


def test_media(spark):
    df = spark.createDataFrame([("a", "junk"), ("b", None), ("c", '{"streams": [{"codec_type": "audio", "sample_rate": "44100", "channels": 2}]}')], "movie_id string, probe string")
    got = {r["movie_id"]: (r["resolution"], r["fps"], r["audio_sample_rate"], r["subtitle_languages"]) for r in media.shape_metadata(df).collect()}
    assert got == {"a": ("unknown", 0.0, None, []), "b": ("unknown", 0.0, None, []), "c": ("unknown", 0.0, 44100, [])}
    movies = spark.createDataFrame([("one", "/m/One.A.mp4")], "movie_id string, path string")
    paths = ["/m/One.A.vtt", "/m/One.A.en.srt", "/m/One.A.srt", "/m/One.B.srt", "/m/One.A.txt", "/s/one-x.ass", "/s/One.A2.ssa", "/s/two.srt"]
    found = media.discover_subtitles(movies, spark.createDataFrame([(p,) for p in paths], "path string"), "/s")
    assert [r["path"] for r in found.orderBy("place").collect()] == ["/m/One.A.srt", "/m/One.A.en.srt", "/m/One.A.vtt", "/s/One.A2.ssa", "/s/one-x.ass"]


def test_merges(spark):
    c = spark.createDataFrame([(1, x, float(k), k + 5.0) for k, x in enumerate("abc")] + [(2, "a", 0.0, 1.0)], "movie_id long, character_id string, first_seen double, last_seen double")
    m = spark.createDataFrame([(1, 1, "a", "b"), (1, 2, "b", "c"), (1, 3, "c", "a"), (1, 4, "c", "c")], "movie_id long, idx int, primary string, merged string")
    got = sorted(tuple(r) for r in D.merge_identities(c, m).select("movie_id", "character_id", "first_seen", "last_seen").collect())
    assert got == [(1, "c", 0.0, 7.0), (2, "a", 0.0, 1.0)]
    e = spark.createDataFrame([(1, "a", "Ann", 0.5, 1), (1, "c", "Ann", 0.5, 2), (1, "b", "Bob", 0.9, 3)], "movie_id long, character_id string, candidate string, confidence double, idx int")
    assert [(r["character_id"], r["name"], r["name_confidence"]) for r in D.vote_again(e, D.resolve_merges(c, m)).collect()] == [("c", "Ann", "high")]


def rows(frame):
    clean = lambda x: None if pd.api.types.is_scalar(x) and pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)
    return sorted(str([clean(x) for x in r]) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_queries(spark, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in catalogue.ORACLES:
        con = duckdb.connect()
        for f in os.listdir(SF):
            con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
        want: pd.DataFrame = con.sql(catalogue.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
