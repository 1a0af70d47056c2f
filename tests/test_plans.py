"""Phases and their report, reuse by content, providers, evidence of names, packing in blocks."""

import hashlib
import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tempograph.__main__ import INPUTS, main
from tempograph.functions import scalars as S
from tempograph.operators import identity as D
from tempograph.operators import providers as P
from tempograph.operators import timeline as T
from tempograph.operators.packing import pack_clips
from tempograph.plans import phases, reuse
from tempograph.plans import stages as M


@pytest.fixture()
def inputs(spark):
    rows = {
        "events": [(m, k, 40.0 * k, "hall", "walk", ["Ann"], f"step {k}", ["hi"] * (k % 2), 5, "low") for m in ("m", "n") for k in range(1, 9)],
        "characters": [(m, "CHARACTER_001", "Ann", 40.0, 320.0) for m in ("m", "n")],
        "appearances": [(m, "CHARACTER_001", k, k, 40.0 * k) for m in ("m", "n") for k in range(1, 9)],
        "movies": [("m", 8, 400.0), ("n", 100, 400.0), ("none", None, None)],
    }
    return {name: spark.createDataFrame(rows[name], kinds) for name, kinds in INPUTS.items()}


def fates(records):
    return {r["phase"]: r["status"] for r in records}


def test_phases_run_what_is_missing(spark, inputs, tmp_path):
    target = str(tmp_path / "t")
    first = phases.run(spark, inputs, target, ["plan"])
    assert list(fates(first)) == ["timeline", "headers", "scenes", "beats", "causal_links", "plan"] and set(fates(first).values()) == {"SUCCESS"}
    assert {r["phase"]: r["rows"] for r in first}["timeline"] == 16
    second = fates(phases.run(spark, inputs, target, ["script"]))
    assert second.pop("script") == "SUCCESS" and set(second.values()) == {"REUSED"}
    # What stands on a table that was made anew is made anew.
    (tmp_path / "t" / "beats" / "_SUCCESS").unlink()
    third = fates(phases.run(spark, inputs, target, ["script"]))
    assert {k for k, v in third.items() if v == "SUCCESS"} == {"beats", "plan", "script"}
    assert set(fates(phases.run(spark, inputs, target, ["beats"], force=True)).values()) == {"SUCCESS"}
    with pytest.raises(ValueError, match="no phase"):
        phases.run(spark, inputs, target, ["nothing"])


def test_a_failing_phase_leaves_its_record(spark, inputs, tmp_path, monkeypatch):
    def broken(t, o):
        raise OSError("disk is full\nat some place")

    graph = [phases.Phase(p.name, p.needs, broken, p.shown) if p.name == "beats" else p for p in phases.GRAPH]
    monkeypatch.setattr(phases, "GRAPH", graph)
    got = phases.run(spark, inputs, str(tmp_path / "t"))
    fate = fates(got)
    assert fate["beats"] == "FAILED" and fate["arcs"] == fate["scenes"] == "SUCCESS"
    assert {fate[x] for x in ("story", "plan", "script", "clips", "items", "captions", "summary")} == {"SKIPPED"}
    report = {r["phase"]: r for r in spark.read.json(str(tmp_path / "t" / "report")).collect()}
    assert report["beats"]["error"] == "disk is full" and report["clips"]["error"] == "script" and report["scenes"]["rows"] == 4
    assert [r["phase"] for r in phases.failed(got)] == ["beats"] and not os.path.exists(tmp_path / "t" / "plan")


def test_derived_totals_and_validation(inputs):
    out = phases.derive(**inputs)
    s = {r["movie_id"]: r for r in out["script_totals"].collect()}
    texts = [r["text"] for r in out["script"].where("movie_id = 'n'").orderBy("segment").collect()]
    assert s["n"]["full_script"] == "\n\n".join(texts) and s["n"]["status"] == "PARTIAL" and len(s["n"]["warnings"]) == 1 and s["m"]["warnings"] == []
    assert s["n"]["total_words"] == sum(len(t.replace("'", " ").split()) for t in texts)
    c = {r["movie_id"]: (r["total_clips"], r["total_seconds"]) for r in out["clip_totals"].collect()}
    assert c["none"] == (0, 0.0) and c["m"] == (out["clips"].where("movie_id = 'm'").count(), round(3.0 * c["m"][0], 2))
    assert {r["movie_id"]: r["valid"] for r in out["plan_validation"].collect()} == {"m": True, "n": True, "none": True}
    lead = out["leads"].where("movie_id = 'm'").first()
    assert (lead["n"], lead["said"]) == (8, 4)
    assert {r["movie_id"]: (r["status"], r["error"], r["n_merges"]) for r in out["summary"].collect()}["none"] == ("FAILED", "no events", 0)
    assert M.first_clips(out["clips"], 1).count() == 2


def test_ties_keep_their_position(spark):
    rows = [("m", k, 5.0, f"s{(k * 37) % 11}") for k in range(11)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(m, 11 - k, t, s, n) for n, (m, k, t, s) in enumerate(rows)], "movie_id string, event int, sec double, summary string, pos int").repartition(4)
    full = frame.withColumns({c: F.lit(None).cast(kind) for c, kind in (("location", "string"), ("action", "string"), ("labels", "array<string>"), ("dialogue", "array<string>"), ("sig", "int"), ("uncertainty", "string"))})
    assert [r["summary"] for r in M.ordered(full).orderBy("idx").collect()] == [s for *_, s in rows]
    assert [r["event"] for r in M.ordered(full.drop("pos")).orderBy("idx").collect()] == list(range(1, 12))


def test_command_line_codes(spark, inputs, tmp_path, capsys):
    source, target = str(tmp_path / "in"), tmp_path / "out"
    for name, df in inputs.items():
        df.write.json(f"{source}/{name}")
    assert main([source, str(target), "--phase", "beats"]) == 0 and (target / "beats").exists() and not (target / "clips").exists()
    assert main([source, str(target)]) == 3 and main([source, str(target), "--resume"]) == 0 and (target / "clips").exists()
    (tmp_path / "in" / "characters" / "part-bad.json").write_text("{broken\n")
    assert main([source, str(target), "--dry-run"]) == 0
    (tmp_path / "in" / "events" / "part-bad.json").write_text('{"movie_id": "x"\n')
    capsys.readouterr()
    assert main([source, str(target), "--force"]) == 4 and "part-bad.json: malformed" in capsys.readouterr().err
    assert main([str(tmp_path / "none"), str(target)]) == 2


def test_reuse_by_content(spark, inputs, tmp_path):
    target, asked = str(tmp_path / "t"), []

    def make(tables):
        asked.append(sorted(r["movie_id"] for r in tables["movies"].select("movie_id").distinct().collect()))
        out = phases.derive(**tables)
        return {k: out[k] for k in ("scenes", "summary")}

    assert reuse.refresh(inputs, make, target) == 3 and reuse.refresh({k: v.repartition(5) for k, v in inputs.items()}, make, target) == 0
    written = lambda: {f"{d}/{x}" for d, _, names in os.walk(target) for x in names if x.endswith(".parquet") and "_finger" not in d}
    before = written()
    changed = inputs | {"events": inputs["events"].withColumn("sig", F.when((F.col("movie_id") == "n") & (F.col("event") == 3), 9).otherwise(F.col("sig")))}
    assert reuse.refresh(changed, make, target) == 1 and asked == [["m", "n", "none"], ["n"]]
    moved = before ^ written()
    assert moved and all("movie_id=n/" in x for x in moved)
    assert spark.read.parquet(f"{target}/scenes").where("movie_id = 'n' and importance = 9").count() == 1
    # A movie that has gone, and one without rows left in a table, lose their partitions.
    gone = {k: v.where("movie_id <> 'm'") for k, v in changed.items()}
    assert reuse.refresh(gone, make, target) == 0
    assert sorted(r["movie_id"] for r in spark.read.parquet(f"{target}/summary").collect()) == ["n", "none"]
    bare = gone | {"events": gone["events"].where("false")}
    assert reuse.refresh(bare, make, target) == 1 and not [x for x in written() if "/scenes/movie_id=n/" in x]
    assert reuse.refresh(bare, make, target, force=True) == 2


class Echo:
    """Answers with the prompt's digest; some frames fail as they are told to."""

    def __init__(self, fails=(), log=None):
        self.fails, self.log, self.asked = dict(fails), log, {}

    def answer(self, frame):
        k = frame["idx"]
        self.asked[k] = self.asked.get(k, 0) + 1
        what = self.fails.get(k)
        if what == "once" and self.asked[k] == 1:
            raise P.ProviderError("busy", 503)
        if what == "lost":
            raise ConnectionError("gone")
        if what in (400, 429):
            raise P.ProviderError("no", what)
        if what == "key":
            raise P.ProviderError("no key", 401, fatal=True)
        if what == "junk":
            return "[1]"
        return json.dumps({"event_summary": f"saw {k} of {len(frame.get('prompt', ''))}", "plot_significance": 99, "visual": {"people_count": "2", "objects": [1]}})


P.register("Echo", Echo)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_provider_answers_and_quarantine(spark):
    frames = spark.createDataFrame([("m", k) for k in range(8)], "movie_id string, idx long").coalesce(1)
    fails = [(1, "once"), (2, "lost"), (3, 400), (4, 429), (5, "junk")]
    good, bad = P.answers(P.describe(frames, " ECHO ", {"fails": fails}, wait=0.001))
    assert {r["idx"]: r["requests"] for r in good.collect()} == {0: 1, 1: 2, 6: 1, 7: 1}
    assert {r["idx"]: (r["requests"], r["error"].split(":")[0]) for r in bad.collect()} == {2: (3, "ConnectionError"), 3: (1, "400"), 4: (3, "429"), 5: (1, "answer doesn't fit")}
    a = good.where("idx = 0").first()["answer"]
    assert (a["people_count"], a["objects"], a["location"], a["plot_significance"], a["location_certainty"], a["interaction"]) == (2, ["1"], "unknown", 10, "medium", None)
    assert P.describe(frames.where("false"), "echo").count() == 0
    with pytest.raises(Exception, match="no key"):
        P.describe(frames, "echo", {"fails": [(1, "key")]}).collect()
    with pytest.raises(ValueError, match="unknown provider 'x'; there are: echo"):
        P.describe(frames, "x")


@pytest.mark.parametrize("text", ["null", "1", "{", '{"visual": []}', '{"visual": {"people_count": "many"}}', '{"visual": {"objects": "x"}}', '{"plot_significance": null}'])
def test_answers_that_do_not_fit(text):
    with pytest.raises(P.ProviderError):
        P.checked(text)


def test_each_answer_is_context_of_the_next(spark):
    rows = [(m, k, f"t{k}", [f"line {k}", None] if k % 2 else None) for m in ("a", "b") for k in range(1, 12)]
    frames = spark.createDataFrame(rows, "movie_id string, idx long, at string, said array<string>").repartition(6)
    done = spark.createDataFrame([("a", 2, "t2", "known"), ("b", 0, "t0", None)], "movie_id string, idx long, at string, summary string")
    fails, want = {4: "lost", 7: 400}, []
    for movie in ("a", "b"):
        lines, of = ["[t0] "] if movie == "b" else [], Echo(fails)
        for m, k, at, said in rows:
            if m == movie and (m, k) == ("a", 2):
                lines.append("[t2] known")
            elif m == movie:
                prompt = P.worded(at, [x for x in said or [] if x], lines[-4:])
                answer = P.ask(of, {"idx": k, "prompt": prompt}, 2, 0)[0]
                want.append((movie, k, prompt, answer and answer["event_summary"]))
                lines += [f"[{at}] {answer['event_summary']}"] if answer else []
    got = P.describe_in_order(frames, "echo", {"fails": list(fails.items())}, done, tries=2, wait=0.001)
    assert sorted((r["movie_id"], r["idx"], r["prompt"], r["answer"] and r["answer"]["event_summary"]) for r in got.collect()) == want
    column = S.prompt(F.lit("t1"), F.array(F.lit("x")), F.array(*[F.lit(f"c{k}") for k in range(6)]))
    assert spark.range(1).select(column.alias("p")).first()["p"] == P.worded("t1", ["x"], [f"c{k}" for k in range(2, 6)])


def test_name_evidence(spark):
    said = [(1.0, "Hey Detective Miller, look here", " Bob "), (2.0, "my name is Anna", None), (3.0, "no names", "The"), (4.0, "my name is Anna", "Bob"), (None, "This is Please", None)]
    events = [("m", 1, 10.0, ["X", "Y"], said), ("m", 2, 20.0, ["X"], said[1:2]), ("m", 3, 30.0, [], said), ("m", 4, 40.0, ["Z"], None)]
    kinds = "movie_id string, idx int, sec double, labels array<string>, dialogue array<struct<start_seconds:double,text:string,speaker:string>>"
    got = D.name_evidence(spark.createDataFrame(events, kinds)).orderBy("idx", "line", "at").collect()
    assert {r["label"] for r in got} == {"X"} and {r["idx"] for r in got} == {1}
    assert [(r["candidate"], r["confidence"], r["sec"]) for r in got[:3]] == [("Bob", 0.9, 1.0), ("Detective Miller", 0.8, 1.0), ("Miller", 0.8, 1.0)]
    assert [(r["candidate"], r["text"]) for r in got[3:]] == [("Anna", "my name is Anna"), ("Bob", "[Speaker Tag: Bob] my name is Anna")]


def test_labels_made_for_people(spark):
    rows = [(1, 3, []), (2, 0, []), (3, -1, None), (4, None, ["A"]), (5, 2, None), (6, 1, ["B", "C"])]
    got = D.seen(spark.createDataFrame(rows, "k int, people_count int, labels array<string>")).orderBy("k").collect()
    assert [(r["k"], r["labels"]) for r in got] == [(1, ["PERSON_A", "PERSON_B", "PERSON_C"]), (4, ["A"]), (5, ["PERSON_A", "PERSON_B"]), (6, ["B", "C"])]


def test_missing_files(spark):
    frames = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "k int, path string")
    files = spark.createDataFrame([("a", 5), ("b", 0), ("a", 5)], "path string, length long")
    assert sorted(r["k"] for r in T.missing_files(frames, files).collect()) == [2, 3, 4] and T.missing_files(frames, files, force=True).count() == 4


@pytest.mark.parametrize(("text", "micros"), [("2024-02-29T23:59:59Z", 0), ("2024-02-29T23:59:59.25+00:00", 250000), ("2024-03-01T00:59:59+01:00", 0), ("2024-02-29T23:59:59", 0)])
def test_iso_times(spark, text, micros):
    at = S.parse_iso(F.lit(text))
    row = spark.range(1).select(F.unix_micros(at).alias("m"), S.iso_time(at).alias("t"), S.parse_iso(F.lit("soon")).alias("bad"), S.digest(F.lit("é")).alias("d")).first()
    assert row["m"] == 1709251199_000000 + micros and row["t"] == "2024-02-29T23:59:59" + (f".{micros:06d}" if micros else "") + "+00:00"
    assert row["bad"] is None and row["d"] == hashlib.sha256("é".encode()).hexdigest()


def fold(rows, length=3.0):
    """One movie's clips in exact hundred-thousandths, one after the other."""
    unit, last, out = 100_000, -999 * 100_000, []
    cents = lambda x: (x * 2 + 1000) // 2000 if x >= 0 else -((-x * 2 + 1000) // 2000)
    stop = max([round(r[2] * unit) for r in rows if r[2] is not None], default=7200 * unit)
    for o, t in sorted((r[0], round(30.0 * r[0] * unit) if r[1] is None else round(r[1] * unit)) for r in rows):
        s = max(0, t - unit // 2)
        e = min(stop, s + round(min(3.0, length) * unit))
        push = s < last + unit
        if push:
            kept = cents(e - s) * 1000
            s = last + 2 * unit
            e = min(stop, s + kept)
        last = e
        out.append((o, cents(s) / 100, cents(e) / 100, cents(e - s) / 100, push))
    return out


@pytest.mark.parametrize("block", [2, 512])
def test_packing_in_blocks_is_one_fold(spark, block):
    rng = random.Random(block)
    movies = {}
    for m in ["a", "b", "c", "d", None]:
        end = rng.choice([None, 50.0, 400.0])
        spread = rng.choice([1.0, 4.0, 9.0])
        movies[m] = [(k, None if rng.random() < 0.1 else round(rng.random() * spread * k + rng.random(), 3), end) for k in range(rng.choice([1, 30, 90])) for _ in range(1 + (rng.random() < 0.1))]
    rows = [(m, *r) for m, of in movies.items() for r in of]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "movie_id string, ord int, t double, movie_end double").repartition(5)
    got = {}
    for r in pack_clips(df, block=block).collect():
        got.setdefault(r["movie_id"], []).append((r["ord"], r["start"], r["stop"], r["duration"], r["pushed"]))
    assert {m: sorted(x) for m, x in got.items()} == {m: sorted(fold(of)) for m, of in movies.items()}
    assert pack_clips(df.where("false")).count() == 0
