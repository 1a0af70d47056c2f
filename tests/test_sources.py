"""Readers and writers of files: encodings, subtitle blocks, the srt format, documents that can't be read, tracks."""

import os

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tempograph.functions import scalars as S
from tempograph.sources import documents, media, srt, subtitles

CUES = "movie_id string, idx int, start_seconds double, end_seconds double, text string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "text", "encoding"),
    [
        ("﻿é日".encode(), "é日", "utf-8"),
        ("plain".encode(), "plain", "utf-8"),
        (b"\x93caf\xe9\x94 \x80 \x85", "“café” € …", "cp1252"),
        (b"caf\xe9 \x81", "café \x81", "latin-1"),
        (bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)), bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252"), "cp1252"),
    ],
)
def test_encodings(spark, tmp_path, raw, text, encoding):
    (tmp_path / "a.srt").write_bytes(raw)
    (tmp_path / "b.srt").write_bytes(b"")
    got = {r["movie_id"][-5:]: r for r in subtitles.read_files(spark, str(tmp_path)).collect()}
    assert (got["a.srt"]["content"], got["a.srt"]["encoding"], got["a.srt"]["error"]) == (text, encoding, None)
    assert got["b.srt"]["error"] == "empty" and srt.decoded(raw) == text


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (r"one\Ntwo\nthree", "one two three"),
        (r"{\an8}{\pos(1,2)}up", "up"),
        ("<i>a</i> <> b", "a <> b"),
        ("hi align:start-ish size:50% line:0,end position:1 there", "hi -ish there"),
        ("a  b\r\n　c\x1c", "a b c"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, S.clean_text(F.lit(raw))) == want


def parsed(spark, name, content):
    rows = subtitles.parse(spark.createDataFrame([(name, content)], "movie_id string, content string")).orderBy("idx").collect()
    return [(r["idx"], r["start_seconds"], r["end_seconds"], r["text"], r["speaker"]) for r in rows]


def test_vtt_blocks(spark):
    text = "WEBVTT\n00:01.000 --> 00:02.000\nin the head\n\n  NOTE x\n00:01.000 --> 00:02.000\nno\n\nSTYLE\n\nid\n00:03.000 --> 00:04.000 align:start\n<v.loud Ann Lee>Hi <b>you</b>\nthere\n\n00:05.000 --> 00:04.000\nback\n\n00:06.000 --> 00:07.000\n<i></i>"
    assert parsed(spark, "a.vtt", text) == [(1, 3.0, 4.0, "Hi you there", "Ann Lee")]


def test_srt_blocks(spark):
    text = "﻿1\r\n00:00:01,5 --> 00:00:02,25\r\nA\r\n \r\n2\r\n1 --> 2 --> 3\r\nno\r\n\r\n3\r\n0:01:00,000 --> 61\r\n<font color=red>B</font>\r\nC\r\n\r\njunk"
    assert parsed(spark, "a.srt", text) == [(1, 1.5, 2.25, "A", None), (2, 60.0, 61.0, "B C", None)]


def test_ass_without_format(spark):
    text = "; x\n[Events]\nDialogue: 0,0:00:05.00,0:00:06.50,Default,Al,0,0,0,,b, c\nDialogue: 0,0:00:01.00,0:00:02.00,Default,,0,0,0,,{\\b1}a\\Nz\n[Fonts]\nDialogue: 0,0:00:01.00,0:00:02.00,D,,0,0,0,,no"
    assert parsed(spark, "x", text) == [(1, 1.0, 2.0, "a z", None), (2, 5.0, 6.5, "b, c", "Al")]


@pytest.mark.parametrize(("content", "n"), [("x" * 150 + "WEBVTT\n\n1.0 --> 2.0\n<v Al>a", 1), ("x" * 300 + "WEBVTT\n\n1.0 --> 2.0\n<v Al>a", 1), ("[EVENTS]\nDialogue: 0,1,2,D,Al,0,0,0,,a", 1), ("", 0)])
def test_sniffed_kinds(spark, content, n):
    rows = parsed(spark, "none", content)
    assert len(rows) == n and (n == 0 or rows[0][4] == (None if "x" * 300 in content else "Al"))


def test_srt_format(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("m/1 ü", k, 1.5 * k, 1.5 * k + 1, f"line {k}\nand more") for k in (2, 1, 3)] + [("b", 1, 0.0, 3661.25, "x"), (None, 1, 0.0, 1.0, "gone")] + [(f"m{k}", 1, None, 2.0, "t") for k in range(20)]
    srt.write_srt(spark.createDataFrame(rows, CUES).repartition(5), path)
    assert len([x for x in os.listdir(path) if x.endswith(".srt")]) == 22 and not os.listdir(f"{path}/_temporary")
    assert (tmp_path / "out" / "b.srt").read_text() == "1\n00:00:00,000 --> 01:01:01,250\nx\n"
    got = sorted(tuple(r) for r in srt.read_srt(spark, path).where("movie_id NOT LIKE 'm_' AND movie_id NOT LIKE 'm1_'").collect())
    assert got == [("b", 1, 0.0, 3661.25, "x")] + [("m/1 ü", k, 1.5 * k, 1.5 * k + 1, f"line {k} and more") for k in (1, 2, 3)]
    native = subtitles.parse(subtitles.read_files(spark, path)).where("movie_id like '%/b.srt'").first()
    assert (native["end_seconds"], native["text"]) == (3661.25, "x")
    # Other movies' files stay or go.
    srt.write_srt(spark.createDataFrame([("b", 1, 0.0, 1.0, "new")], CUES), path, overwrite=False)
    assert srt.read_srt(spark, path).select("movie_id").distinct().count() == 22 and srt.read_srt(spark, f"{path}/b.srt").first()["text"] == "new"
    srt.write_srt(spark.createDataFrame([("c", 1, 0.0, 1.0, "only")], CUES), path)
    assert [r["movie_id"] for r in srt.read_srt(spark, path).collect()] == ["c"]


def test_srt_failed_task_leaves_no_file(spark, tmp_path):
    path = str(tmp_path / "out")
    bad = F.when(F.col("movie_id") == "m7", F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
    cues = spark.createDataFrame([(f"m{k}", 1, 0.0, 1.0, "t") for k in range(9)], CUES).withColumn("text", bad)
    with pytest.raises(Exception, match="lost"):
        srt.write_srt(cues, path)
    assert [x for _, _, names in os.walk(path) for x in names] == []
    with pytest.raises(PythonException):
        srt.register(spark)
        mixed = spark.createDataFrame([("a", 1, 0.0, 1.0, "t"), ("b", 1, 0.0, 1.0, "t"), ("a", 2, 1.0, 2.0, "t")], CUES).coalesce(1)
        mixed.write.format("srt").mode("append").save(path)
    assert [x for _, _, names in os.walk(path) for x in names] == []


def test_documents_strict_and_tolerant(spark, tmp_path):
    for name, text in {"a.json": '{"n": 1, "s": "x"}', "b.json": '{"n": "many", "s": "y"}', "c.json": '{"n": ', "d.json": "", "e.json": "[1]"}.items():
        (tmp_path / name).write_text(text)
    good, bad = documents.read_checked(spark, str(tmp_path), "n int, s string")
    assert sorted((r["path"][-6:], r["n"], r["s"]) for r in good.collect()) == [("a.json", 1, "x"), ("b.json", None, "y")]
    assert sorted((r["path"][-6:], r["error"]) for r in bad.collect()) == [("c.json", "malformed"), ("d.json", "empty"), ("e.json", "no object")]
    with pytest.raises(documents.DocumentError, match="c.json: malformed"):
        documents.read_strict(spark, str(tmp_path), "n int, s string")
    with pytest.raises(documents.DocumentError) as found:
        documents.read_strict(spark, str(tmp_path / "none"), "n int")
    assert found.value.missing
    assert [x.count() for x in documents.read_tolerant(spark, str(tmp_path / "none"), "n int")] == [0, 0]
    assert documents.read_strict(spark, str(tmp_path / "a.json"), "n int, s string").first()["n"] == 1


def test_positions_in_files(spark, tmp_path):
    rows = [(k, (k * 7919) % 101) for k in range(1000)]
    spark.createDataFrame(rows, "k long, v long").coalesce(1).write.parquet(str(tmp_path / "t"))
    got = documents.in_file_order(spark.read.parquet(str(tmp_path / "t"))).repartition(8).orderBy("pos").collect()
    assert [r["k"] for r in got] == list(range(1000))


def test_probe_errors(spark):
    probes = spark.createDataFrame([(1, '{"format": {}}'), (2, '{"streams": []}'), (3, "junk"), (4, None), (5, "[]")], "movie_id int, probe string")
    good, bad = media.check_probes(probes)
    assert [r["movie_id"] for r in good.collect()] == [1]
    assert sorted((r["movie_id"], r["error"]) for r in bad.collect()) == [(2, "no format"), (3, "malformed"), (4, "empty"), (5, "no object")]


TRACKS = [(0, 2, "hdmv_pgs_subtitle", "eng", True), (1, 3, "SubRip", "fra", False), (2, 4, "ass", "msa", False), (3, 5, "mov_text", "en-GB", False), (4, 6, "srt", None, None)]


@pytest.mark.parametrize(
    ("index", "language", "tracks", "want"),
    [
        (2, None, TRACKS, (1, 2)),
        (9, "fr", TRACKS, None),
        (None, " FR ", TRACKS, (2, 3)),
        (None, "de", TRACKS, (4, 5)),
        (None, "", TRACKS, (4, 5)),
        (None, "de", [*TRACKS, (5, 7, "vtt", "zho", True)], (3, 7)),
        (None, None, TRACKS[1:3], (4, 4)),
        (None, None, [TRACKS[1], TRACKS[4]], (5, 3)),
        (None, "eng", TRACKS[:1], None),
    ],
)
def test_track_choice(spark, index, language, tracks, want):
    df = spark.createDataFrame([(1, *t) for t in tracks], "movie_id int, pos int, stream_index int, codec_name string, language string, is_default boolean")
    got = media.choose_subtitle(df, ["movie_id"], F.lit(index).cast("int"), F.lit(language).cast("string")).first()
    assert (got and (got["rule"], got["stream_index"])) == want
