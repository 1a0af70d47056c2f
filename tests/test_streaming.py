"""Streams: identities over batches, late events and a stored cast; sinks that a restart doesn't double."""

import pytest

from tempograph.streaming.incremental import current, process_new, upsert_new
from tempograph.streaming.tracking import track, track_all

EVENTS = "movie_id string, idx long, sec double, people_count int, labels array<string>"
CAST = "movie_id string, character_id string, place int, last_seen double, labels array<string>"
ROWS = [
    ("a", 1, 0.0, 2, ["X", "Y"]), ("a", 2, 5.0, 1, []), ("a", 3, 30.0, 0, []), ("a", 4, 60.0, 3, None), ("a", 5, 90.0, None, ["Y", "Z"]), ("a", 6, 95.0, 1, ["Q"]),
    ("b", 1, 0.0, 1, ["X"]), ("b", 2, None, 1, ["W", None]), ("b", 3, 61.0, 1, ["X"]), (None, 1, 0.0, 1, ["X"]),
]
KNOWN = [("a", "CHARACTER_007", 0, 2.0, ["X", "Q"]), ("a", "CHARACTER_003", 1, 50.0, ["Q"]), ("b", "guest", 0, 0.0, ["X"])]


def plain(rows, known=()):
    """A loop over events in order: the last label of a character within 10 s, else the only one of that label, else a new one."""
    out = []
    for movie in {r[0] for r in rows}:
        people = [{"id": k[1], "seen": k[3], "labels": list(k[4])} for k in known if k[0] == movie]
        number = max([int(p["id"][10:]) for p in people if p["id"].startswith("CHARACTER_")], default=0)
        for _, idx, sec, count, labels in sorted((r for r in rows if r[0] == movie), key=lambda r: r[1]):
            sec = 30.0 * idx if sec is None else sec
            labels = [x for x in labels or [] if x is not None] or ["PERSON_" + "ABCDEFGH"[k] for k in range(count or 0)]
            for label in labels:
                p = next((p for p in people if abs(sec - p["seen"]) <= 10 and p["labels"][-1:] == [label]), None)
                same = [q for q in people if label in q["labels"]]
                p = p or (same[0] if len(same) == 1 else None)
                if p is None:
                    number += 1
                    p = {"id": f"CHARACTER_{number:03d}", "seen": sec, "labels": []}
                    people.append(p)
                p["seen"] = sec
                p["labels"].append(label)
                out.append((movie, idx, label, p["id"]))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["movie_id"], r["idx"], r["label"], r["character_id"]) for r in frame.collect()), key=str)


@pytest.fixture()
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


@pytest.mark.parametrize("known", [[], KNOWN], ids=["new", "stored cast"])
def test_table(spark, known):
    assert got(track_all(spark.createDataFrame(ROWS, EVENTS), spark.createDataFrame(known, CAST) if known else None)) == plain(ROWS, known)
    assert track_all(spark.createDataFrame([], EVENTS)).count() == 0


def run(spark, tmp_path, parts, **more):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(src)
        process_new(spark, src, spark.createDataFrame([], EVENTS).schema, lambda df: track(df, **more), out, mark)
    return got(spark.read.parquet(out))


@pytest.mark.parametrize("known", [[], KNOWN], ids=["new", "stored cast"])
def test_batches_go_on_numbering(rocks, tmp_path, known):
    parts = [[r for r in ROWS if r[1] == k] for k in range(1, 7)]
    more = {"known": rocks.createDataFrame(known, CAST)} if known else {}
    assert run(rocks, tmp_path, parts, **more) == plain(ROWS, known)


def test_late_events_equal_one_batch(rocks, tmp_path):
    """Events that come before earlier ones wait; a far event of another movie moves the watermark on."""
    rows = [("a", k, 10.0 * k, 1, ["XYZXWYVQ"[k % 8]]) for k in range(1, 20)]
    parts = [[rows[k] for k in at] for at in ([2, 0, 5], [1, 4, 3, 9], [8, 6, 7], [12, 10, 11], [14, 13, 16], [15, 18, 17])]
    result = run(rocks, tmp_path, [*parts, [("end", 1, 1000.0, 0, [])], [("end", 2, 2000.0, 0, [])]], hold="100 seconds")
    assert result == plain(rows)


def upserted(spark, tmp_path, parts, fail_at=None):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    kinds = "k long, v string"
    for n, part in enumerate(parts):
        if part:
            spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(src)

        def save(batch, folder, n=n):
            batch.write.mode("overwrite").parquet(folder)
            if n == fail_at:
                raise RuntimeError("killed")

        try:
            upsert_new(stream, out, mark, save)
        except Exception as error:
            assert n == fail_at and "killed" in str(error)
    return sorted((tuple(r) for r in current(spark, out, ["k"]).select("k", "v").collect()), key=str)


def test_upsert_counts_a_replayed_batch_once(spark, tmp_path):
    """The second batch is written, but its end isn't noted: it runs again under the same number."""
    parts = [[(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (None, "n")], [], [(4, "e")]]
    got = upserted(spark, tmp_path, parts, fail_at=1)
    assert got == sorted([(1, "a"), (2, "c"), (3, "d"), (None, "n"), (4, "e")], key=str)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
