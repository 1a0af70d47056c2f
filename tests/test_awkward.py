"""Nulls, ties, repeats, empty tables and clashing columns of the operators."""

from pyspark.sql import functions as F

from tempograph.operators import intervals as I
from tempograph.operators import timeline as T
from tempograph.sources import subtitles

KINDS = "movie_id string, idx int, sec double, label string, sig int, scene int, beat string, bucket string"
ROWS = [("m", 1, 0.0, "a", 5, 1, "x", "y"), ("m", 2, None, None, None, 1, None, None), ("m", 2, None, None, None, 1, None, None), ("m", 3, 90.0, "b", 9, 1, None, None), (None, 1, 5.0, "a", 1, 1, None, None)]


def frame(spark):
    return spark.createDataFrame(ROWS, KINDS)


def test_windows(spark):
    df, none = frame(spark), frame(spark).where("false")
    got = T.rolling_context(df, "label").where("idx = 3").first()
    assert got["context"] == ["a"] and got["beat"] is None and T.rolling_context(none, "label").count() == 0
    s = T.sessionize(df.drop("scene"), T.by_gap(10.0), 2).orderBy("movie_id", "idx").collect()
    assert [r["scene"] for r in s if r["movie_id"] == "m"] == [1, 2, 2, 3] and [r["scene"] for r in s if r["movie_id"] is None] == [1]
    assert T.scene_records(df).where("movie_id = 'm'").first()["start_seconds"] == 0.0
    assert T.layout(df.withColumn("duration", F.when(F.col("idx") != 2, 1.5).cast("decimal(12,2)"))).where("movie_id = 'm' and idx = 3").first()["end_seconds"] == 3


def test_groups(spark):
    df, none = frame(spark), frame(spark).where("false")
    assert T.modes(df, ["movie_id"], "label", "idx").where("movie_id = 'm'").first()["label"] is None
    ids = {(r["movie_id"], r["label"]): (r["character_id"], r["appearances"]) for r in T.identities(df).collect()}
    assert ids[("m", None)] == ("CHARACTER_002", 2) and ids[(None, "a")] == ("CHARACTER_001", 1) and T.identities(none).count() == 0
    assert T.first_of(df, ["movie_id", "label"]).count() == 4
    votes = T.vote(df.select("movie_id", "idx", F.col("label").alias("candidate"), F.lit(None).cast("double").alias("confidence")))
    assert {r["movie_id"]: (r["votes"], r["name"]) for r in votes.collect()} == {"m": (2, None), None: (1, None)}
    assert T.or_all(df, ["movie_id"], F.col("sig") > 5).count() == 2 and T.or_all(df, ["movie_id"], F.col("sig") > 99).count() == 5
    assert T.subsample(df, ["movie_id"], "idx", F.lit(9)).count() == 5 and T.subsample(df, ["movie_id"], "idx", F.lit(0)).count() == 0 and T.subsample(none, ["movie_id"], "idx", F.lit(2)).count() == 0
    assert T.metrics(df.select("movie_id", F.lit("OTHER").alias("item_type"), F.lit(None).cast("decimal(12,2)").alias("duration"))).where("movie_id = 'm'").first()["clips"] == 0
    assert T.causal_pairs(df.withColumn("title", F.col("label"))).where("movie_id = 'm'").count() == 1


def test_joins(spark):
    df = frame(spark)
    assert T.pending(df, df.where("idx = 1")).count() == 4 and T.pending(df, df, force=True).count() == 5 and T.pending(df, df.where("false"), 1).count() == 2
    a = spark.createDataFrame([(1, "p"), (1, "p"), (2, None), (3, "q")], "a int, item string")
    b = spark.createDataFrame([(7, "p"), (8, None)], "b int, item string")
    assert [tuple(r) for r in T.overlap_join(a, b, "item").collect()] == [(1, 7)]
    chosen = T.choose_track(df, ["movie_id"], [F.col("sig") > 8, F.col("sig") > 4], ["idx"])
    assert {r["movie_id"]: (r["idx"], r["rule"]) for r in chosen.collect()} == {"m": (3, 0), None: (1, 2)}
    grid = I.time_grid(spark.createDataFrame([(1, None), (2, -1.0), (3, 1.0), (3, 1.0)], "movie_id int, duration double"), 0.5)
    assert {r["movie_id"]: r["count"] for r in grid.groupBy("movie_id").count().collect()} == {1: 1, 2: 1, 3: 6}


def test_subtitles_without_content(spark):
    docs = spark.createDataFrame([("a", None), ("b", ""), ("c", "x --> y"), (None, "1 --> 2\nz")], "movie_id string, content string")
    for parse in (subtitles.parse_srt, subtitles.parse_vtt):
        assert [(r["movie_id"], r["idx"], r["text"]) for r in parse(docs).collect()] == [(None, 1, "z")]
    assert subtitles.parse_ass(docs).count() == 0 and subtitles.parse(docs).count() == 1 and subtitles.parse(docs.where("false")).count() == 0
    cues = spark.createDataFrame([("a", 1, None, 1.0, "t"), ("a", 2, 1.0, 2.0, None)], "movie_id string, idx int, start_seconds double, end_seconds double, text string")
    assert subtitles.to_srt(cues).first()["content"] == "1\nt\n\n2\n00:00:01,000 --> 00:00:02,000"
