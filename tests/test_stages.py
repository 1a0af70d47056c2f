"""Hand-derived movies through the stages: a complete one, one of nulls, and one without events."""

import pytest
from pyspark.sql import functions as F

from tempograph.__main__ import INPUTS, main
from tempograph.functions import scalars as S
from tempograph.plans import stages as M
from tempograph.sources.documents import staged


@pytest.fixture(scope="module")
def movie(spark):
    e = [
        (1, 1, 0.0, "Black screen title", "words fade", ["PERSON_A"], "A title", None, 2, None),
        (1, 2, 30.0, "Nightclub", "people dance", ["Ann"], "A party", ["hi"], 4, "low"),
        (1, 3, 60.0, "the club", None, ["Ann"], "A party", None, 5, "medium"),
        (1, 4, 300.0, "forest", "run", [], "They run", None, 9, "HIGH"),
        (1, 5, 330.0, "bunker in the forest", "hide", ["Bob"], "An attack", None, 7, "low"),
        (2, None, None, None, None, None, None, None, None, None),
    ]
    events = spark.createDataFrame(e, "movie_id int, event int, sec double, location string, action string, labels array<string>, summary string, dialogue array<string>, sig int, uncertainty string")
    characters = spark.createDataFrame([(1, "CHARACTER_001", "Ann", 30.0, 60.0), (1, "CHARACTER_002", None, 330.0, 330.0)], "movie_id int, character_id string, name string, first_seen double, last_seen double")
    appearances = spark.createDataFrame([(1, "CHARACTER_001", 1, 2, 30.0), (1, "CHARACTER_001", 2, 3, 60.0), (1, "CHARACTER_002", 3, 5, 330.0)], "movie_id int, character_id string, ord int, event int, sec double")
    movies = spark.createDataFrame([(1, 5, 400.0), (2, 100, None), (3, None, None)], "movie_id int, samples int, duration double")
    events = staged(M.with_cast(M.ordered(events), characters, appearances), "t-events")
    scenes, heads = staged(M.scenes(events), "t-scenes"), staged(M.headers(events, movies), "t-heads")
    beats = staged(M.beats(scenes), "t-beats")
    plan = staged(M.plan(heads, beats, M.causal_links(events)), "t-plan")
    script = staged(M.script(plan, scenes, events, heads), "t-script")
    return {"events": events, "characters": characters, "appearances": appearances, "scenes": scenes, "heads": heads, "beats": beats, "plan": plan, "script": script}


def got(df, *columns):
    return [tuple(r) for r in df.where("movie_id = 1").select(*columns).orderBy(columns[0]).collect()]


def test_scenes_and_beats(movie):
    assert got(movie["scenes"], "scene", "event_indices", "scene_function", "location", "characters", "uncertainty") == [
        (1, [1], "SETUP", "Black screen title", [], "medium"),
        (2, [2, 3], "INTRODUCTION", "Nightclub", ["Ann"], "medium"),
        (3, [4], "CLIMAX", "forest", [], "low"),
        (4, [5], "ESCALATION", "bunker in the forest", ["Bob", "CHARACTER_002"], "low"),
    ]
    assert got(movie["scenes"], "scene", "summary", "start_seconds", "end_seconds")[1] == (2, "A party", 30.0, 90.0)
    assert got(movie["beats"], "beat", "title", "supporting_scenes", "event_indices") == [
        (1, "Passage: SETUP", [1], [1]),
        (2, "Introduction", [2, 3], [2, 3, 4]),
        (3, "Escalation", [4], [5]),
    ]
    blank = movie["scenes"].where("movie_id = 2").first()
    assert (blank["event_indices"], blank["location"], blank["summary"], blank["importance"]) == ([1], "Unspecified location", "Nothing was described.", 5)


def test_links_and_arcs(movie):
    rules = [((3, 5), (9, 4), "cause", "effect", (3, 4, 5)), ((1,), (), "c", "e", (1,)), ((8,), (), "no", "no", (8,))]
    assert got(M.causal_links(movie["events"], rules), "ord", "cause", "confidence", "evidence") == [(1, "cause", "high", [3, 4, 5]), (2, "c", "high", [1])]
    pairs = got(M.causal_links(movie["events"]), "ord", "cause", "effect", "evidence")
    assert len(pairs) == 3 and pairs[0] == (1, "A title", "Then: A party", [1, 2])
    a = got(M.arcs(movie["events"], movie["characters"], movie["appearances"]), "character_id", "introduction", "major_decisions")
    assert a[0] == ("CHARACTER_001", "First seen at 30.0 s (event 2), Nightclub: people dance.", [M.NO_DECISION])


def test_plan_and_script(movie):
    assert [tuple(r) for r in movie["heads"].select("movie_id", "story_status", "target_seconds", "movie_end").orderBy("movie_id").collect()] == [(1, "COMPLETE", 900.0, 400.0), (2, "PARTIAL", 45.0, 7200.0), (3, "PARTIAL", 45.0, 7200.0)]
    assert got(movie["plan"], "segment", "purpose", "seconds", "event_indices") == [(1, "story_progression", 100.0, [1]), (2, "setting_shift_and_character_intro", 450.0, [2, 3, 4]), (3, "rising_action_and_crisis", 350.0, [5])]
    assert len(got(movie["plan"], "segment", "key_points")[1][1]) == 5
    text = got(movie["script"], "segment", "text", "word_count")
    assert len(text) == 3 and text[0][1] == "The story opens with a hook. At Black screen title we see how they get by. This leads on: then: a party"
    assert [(r["movie_id"], r["segment"], r["is_continuation"]) for r in movie["script"].where("movie_id > 1").orderBy("movie_id", "segment").collect()] == [(2, 1, False), (2, 2, True), (3, 1, True)]


def test_clips_items_captions(movie):
    clips = staged(M.clips(movie["script"], movie["scenes"], movie["events"], movie["heads"]), "t-clips")
    assert got(clips, "ord", "event", "scene", "start", "duration", "pushed") == [(1, 1, 1, 0.0, 3.0, False), (2, 2, 2, 29.5, 3.0, False), (3, 3, 2, 59.5, 3.0, False), (4, 4, 3, 299.5, 3.0, False), (5, 5, 4, 329.5, 3.0, False)]
    items = staged(M.items(movie["script"], clips, freezes=1), "t-items")
    kinds = "".join(x[1][0] + x[1][1] for x in got(items, "idx", "item_type"))
    assert kinds == "SOSTBLSOSOSOBLSOBL"
    m = M.manifest(items).where("movie_id = 1").first()
    assert (float(m["total"]), m["clips"], m["placeholders"], float(m["longest_freeze"]), m["moving_percent"]) == (16.9, 5, 4, 1.0, 88.8)
    c = got(M.captions(movie["script"], items), "idx", "start_seconds", "end_seconds", "text")
    assert c[0][1] == 0.0 and c[-1][2] == 16.9 and all(a[2] == b[1] or b[1] in (4.3, 13.6) for a, b in zip(c, c[1:], strict=False))
    assert sorted(r["movie_id"] for r in items.where("movie_id > 1").collect()) == [2, 2, 2, 2, 3]


def test_story(movie):
    leads = M.leads(movie["events"], movie["characters"], movie["appearances"])
    rows = {r["movie_id"]: r for r in M.story(movie["heads"], movie["scenes"], movie["beats"], leads, M.ambiguous(movie["events"])).collect()}
    assert rows[1]["open_uncertainties"] == ["Events that can be read in several ways: [4].", "How the scenes outdoors and those at the club are connected is unconfirmed."]
    assert "scenes 4, beats 3, coverage COMPLETE" in rows[1]["story_summary"] and "Ann" in rows[1]["story_summary"]
    assert rows[3]["story_summary"] == "There are no events to tell a story from."


def test_leads(spark):
    events = spark.createDataFrame([(1, k, 10.0 * k, 5) for k in range(10)], "movie_id int, event int, sec double, sig int")
    characters = [(1, "c1", None, 10.0, 19.0), (1, "c2", "Ann", None, None), (1, "c3", "Ann", 0.0, 90.0), (1, "c4", "Unknown", 9.0, None), (2, "c1", "Bob", 0.0, 1.0)]
    characters = spark.createDataFrame(characters, "movie_id int, character_id string, name string, first_seen double, last_seen double")
    appearances = spark.createDataFrame([(1, "c1", 1), (1, "c1", 2), (1, "c3", 3), (1, "c3", 99)], "movie_id int, character_id string, event int")
    got = [tuple(r) for r in M.leads(events, characters, appearances).select("rank", "character_id", "who", "n", "score").orderBy("rank").collect()]
    assert got == [(1, "c3", "Ann", 2, 0.58), (2, "c1", "c1", 2, 0.21), (3, "c2", "Ann", 0, 0.2), (4, "c4", "Unknown", 0, 0.1)]


@pytest.mark.parametrize(("text", "width", "want"), [("one two three", 8, "one two\nthree"), ("one two", 7, "one\ntwo"), ("a b c d e", 3, "a b\nc d e"), ("", 9, ""), ("word", 2, "word")])
def test_wrap(spark, text, width, want):
    assert spark.range(1).select(S.wrap_caption(F.lit(text), width).alias("x")).first()["x"] == want


def test_blank_caption(spark):
    assert spark.range(1).select(S.caption_chunks(F.lit("")).alias("x")).first()["x"] == [""]


@pytest.mark.parametrize("kind", ["json", "parquet"])
def test_command_line(spark, tmp_path, capsys, kind):
    source, target = str(tmp_path / "in"), tmp_path / "out"
    assert main([source, str(target), "--format", kind]) == 2
    data = {
        "events": [("m", k, 40.0 * k, "hall", "walk", ["Ann"], f"step {k}", None, 5, "low") for k in range(1, 9)],
        "characters": [("m", "CHARACTER_001", "Ann", 40.0, 320.0)],
        "appearances": [("m", "CHARACTER_001", k, k, 40.0 * k) for k in range(1, 9)],
        "movies": [("m", 8, 400.0)],
    }
    for name, rows in data.items():
        getattr(spark.createDataFrame(rows, INPUTS[name]).write, kind)(f"{source}/{name}")
    assert main([source, str(target), "--format", kind, "--dry-run"]) == 0 and not target.exists()
    assert "scenes 2" in capsys.readouterr().out
    assert main([source, str(target), "--format", kind]) == 0
    assert main([source, str(target), "--format", kind]) == 3 and main([source, str(target), "--format", kind, "--force"]) == 0
    read = lambda name: getattr(spark.read, kind)(str(target / name))
    assert read("summary").select("status", "n_events", "n_scenes").first() == ("SUCCESS", 8, 2)
    assert read("leads").first()["who"] == "Ann" and read("validation").where("not valid").count() == 0


def test_rules_of_a_film(movie):
    """Prose by words of scenes and events, decisions and arcs, all given by the caller."""
    prose = [("nothing", ("they run",), "Somebody runs."), *M.PROSE]
    assert [x[1] for x in got(M.script(movie["plan"], movie["scenes"], movie["events"], movie["heads"], prose), "segment", "text")][1] == "Somebody runs."
    decisions, kinds = [(("party",), "Went out"), (("attack",), "Fought")], [(("attack",), "a conflict", "an aim", "a change", "an end")]
    a = got(M.arcs(movie["events"], movie["characters"], movie["appearances"], decisions, kinds), "character_id", "major_decisions", "conflict")
    assert a == [("CHARACTER_001", ["Went out"], M.NO_ARC[0]), ("CHARACTER_002", ["Fought"], "a conflict")]
