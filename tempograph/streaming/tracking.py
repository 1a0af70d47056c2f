"""Identities as a stream: each movie numbers its labels in order of appearance, across batches, and from a stored cast.

A movie's state is keyed: a value with the highest number so far, and a map from each character to its place, last sighting, last label
and labels. A stored cast is the initial state. With ``hold``, events wait in a map of their own, and event-time timers release them
once the watermark has passed, so that events which come late within it are numbered as if all had come in order.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds within which the last label of a character is taken for the same one.
NEAR = 10.0
OUT = "movie_id string, idx long, sec double, place int, label string, character_id string, created boolean"
PERSON = "place int, last_seen double, last_label string, labels array<string>"
COLUMNS = ["idx", "sec", "place", "label", "character_id", "created"]


class Cast:
    """The characters of a movie in order of creation, and by each label they have had."""

    def __init__(self, number: int = 0):
        self.number, self.people, self.by_label = number, {}, {}

    def restore(self, name: str, last_seen: float, labels: list[str], last_label: str | None = None) -> None:
        """A character with its labels in order; numbering goes on from the highest number in any id."""
        found = re.search(r"CHARACTER_(\d+)", name)
        self.number = max(self.number, int(found[1]) if found else 0)
        self.people[name] = [last_seen, last_label if last_label is not None else labels[-1] if labels else None]
        for label in dict.fromkeys(labels):
            self.by_label.setdefault(label, []).append(name)

    def find(self, label: str, sec: float) -> tuple[str, bool]:
        same = self.by_label.get(label, [])
        for name in same:
            last_seen, last_label = self.people[name]
            if last_label == label and abs(sec - last_seen) <= NEAR:
                return name, False
        if len(same) == 1:
            return same[0], False
        self.number += 1
        name = f"CHARACTER_{self.number:03d}"
        self.by_label.setdefault(label, []).append(name)
        return name, True

    def event(self, sec: float, people: int, labels: list[str]) -> list[tuple[int, str, str, bool]]:
        """(place, label, character, created) of those seen; people without labels get some, an event without either has none."""
        out = []
        for place, label in enumerate(labels or [f"PERSON_{chr(65 + k)}" for k in range(people)]):
            name, created = self.find(label, sec)
            self.people[name] = [sec, label]
            out.append((place, label, name, created))
        return out


def _rows(pdf: pd.DataFrame) -> Iterator[tuple[int, float, int, list[str]]]:
    """Events of a batch; a null time is 30 s for each ordinal, null people or labels none, a null label no label."""
    for idx, sec, people, labels in zip(pdf["idx"], pdf["sec"], pdf["people_count"], pdf["labels"], strict=True):
        if not pd.isna(idx):
            yield int(idx), 30.0 * idx if pd.isna(sec) else float(sec), 0 if pd.isna(people) else int(people), [x for x in (labels if labels is not None else []) if x is not None]


class Tracker(StatefulProcessor):
    def __init__(self, hold: bool):
        self.hold = hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.number = handle.getValueState("number", "number int")
        self.people = handle.getMapState("people", "character_id string", PERSON)
        self.waiting = handle.getMapState("waiting", "idx long, copy int", "sec double, people int, labels array<string>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        cast = Cast()
        for place, (name, last_seen, labels) in enumerate(initialState.sort_values("place", kind="stable")[["character_id", "last_seen", "labels"]].itertuples(index=False)):
            labels = [x for x in (labels if labels is not None else []) if x is not None]
            cast.restore(name, float(last_seen), labels)
            self.people.updateValue((name,), (place, float(last_seen), labels[-1] if labels else None, labels))
        self.number.update((cast.number,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.hold:
            yield self._number(key, [e for pdf in rows for e in _rows(pdf)])
            return
        for pdf in rows:
            for idx, sec, people, labels in _rows(pdf):
                copy = 0
                while self.waiting.containsKey((idx, copy)):
                    copy += 1
                self.waiting.updateValue((idx, copy), (sec, people, labels))
                self.handle.registerTimer(_millis(sec))
        yield pd.DataFrame(columns=["movie_id", *COLUMNS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until, due = expiredTimerInfo.getExpiryTimeInMs(), []
        for (idx, copy), (sec, people, labels) in list(self.waiting.iterator()):
            if _millis(sec) <= until:
                due.append((idx, sec, people, list(labels or [])))
                self.waiting.removeKey((idx, copy))
        yield self._number(key, due)

    def _number(self, key, events) -> pd.DataFrame:
        if not events:
            return pd.DataFrame(columns=["movie_id", *COLUMNS])
        cast, known = Cast(self.number.get()[0] if self.number.exists() else 0), {}
        for (name,), (place, last_seen, last_label, labels) in sorted(self.people.iterator(), key=lambda x: x[1][0]):
            cast.restore(name, last_seen, list(labels or []), last_label)
            known[name] = [place, list(labels or [])]
        out = []
        for idx, sec, people, labels in sorted(events, key=lambda e: (e[0], e[1])):
            for seen in cast.event(sec, people, labels):
                mine = known.setdefault(seen[2], [len(known), []])
                if seen[1] not in mine[1]:
                    mine[1].append(seen[1])
                out.append((idx, sec, *seen))
        for name in {x[4] for x in out}:
            place, labels = known[name]
            self.people.updateValue((name,), (place, *cast.people[name], labels))
        self.number.update((cast.number,))
        return pd.DataFrame(out, columns=COLUMNS).assign(movie_id=key[0])[["movie_id", *COLUMNS]]

    def close(self) -> None:
        pass


def _millis(sec: float) -> int:
    return int(round(sec * 1000))


def _plain(events: DataFrame) -> DataFrame:
    return events.select(F.col("movie_id").cast("string"), F.col("idx").cast("long"), F.col("sec").cast("double"), F.col("people_count").cast("int"), F.col("labels").cast("array<string>"))


def track(events: DataFrame, known: DataFrame | None = None, hold: str | None = None) -> DataFrame:
    """movie_id, idx, sec, place, label, character_id, created of a stream of events (movie_id, idx, sec, people_count, labels).

    known: a stored cast (movie_id, character_id, place, last_seen, labels in order), the state to start from. Within a batch a movie's events
    go by idx. hold: how long events wait for others of their stream ("30 seconds", by ``sec``); events that come later still are dropped by
    Spark, and the last ones wait for the watermark. Events of a null idx have no place and are dropped; repeated rows count each.
    The session needs the RocksDB state store.
    """
    rows = _plain(events)
    if hold:
        rows = rows.withColumn("at", F.timestamp_millis(F.round(F.coalesce("sec", 30.0 * F.col("idx")) * 1000).cast("long"))).withWatermark("at", hold)
    start = None if known is None else known.select(F.col("movie_id").cast("string"), "character_id", F.col("place").cast("int"), F.col("last_seen").cast("double"), F.col("labels").cast("array<string>")).groupBy("movie_id")
    return rows.groupBy("movie_id").transformWithStateInPandas(Tracker(bool(hold)), OUT, "Append", "EventTime" if hold else "None", start)


def track_all(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The same of a table: movies lie in partitions, each in order, and stream through a task one event after the other."""
    rows = _plain(events).where("idx IS NOT NULL").withColumn("known", F.lit(None).cast("string"))
    if known is not None:
        stored = F.to_json(F.struct("character_id", "last_seen", "labels"))
        rows = rows.unionByName(known.select(F.col("movie_id").cast("string"), F.col("place").cast("long").alias("idx"), stored.alias("known")), allowMissingColumns=True)
    ordered = rows.repartition("movie_id").sortWithinPartitions("movie_id", F.col("known").isNull(), "idx", "sec")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        movie, cast = object(), Cast()
        for pdf in batches:
            out = []
            for here, idx, sec, people, labels, stored in pdf[["movie_id", "idx", "sec", "people_count", "labels", "known"]].itertuples(index=False):
                here = None if pd.isna(here) else here
                if here != movie:
                    movie, cast = here, Cast()
                if stored is not None and not pd.isna(stored):
                    x = json.loads(stored)
                    cast.restore(x["character_id"], x["last_seen"], [y for y in x.get("labels") or [] if y is not None])
                    continue
                for event in _rows(pd.DataFrame({"idx": [idx], "sec": [sec], "people_count": [people], "labels": [labels]})):
                    out += [(movie, *event[:2], *seen) for seen in cast.event(*event[1:])]
            yield pd.DataFrame(out, columns=["movie_id", *COLUMNS])

    return ordered.mapInPandas(run, OUT)
