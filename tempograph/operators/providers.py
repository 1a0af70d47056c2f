"""Describing frames by an outside provider: protocol, registry, response check, retry by status, and frames that fail set apart.

A provider answers a frame with a JSON text. Calls run in tasks, a row at a time, since each is a request; a frame whose answer doesn't come
or doesn't fit goes on with its error instead of failing the task, so that what was paid for isn't asked again.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses after which a request is tried again, and what a missing field of an answer becomes.
TRANSIENT = (429, 500, 502, 503, 504)
VISUAL = {"people_count": 0, "character_labels": [], "location": "unknown", "action": "unknown action", "objects": [], "emotion": "neutral", "interaction": None, "visible_text": None}
UNCERTAINTY = {"character_identity": "medium", "event_interpretation": "medium", "location_certainty": "medium"}
SUMMARY, SIGNIFICANCE = "Event recorded.", 5
ANSWER = (
    "people_count int, character_labels array<string>, location string, action string, objects array<string>, emotion string, interaction string, visible_text string, "
    "character_identity string, event_interpretation string, location_certainty string, event_summary string, plot_significance int"
)


class ProviderError(Exception):
    """A request that failed, with its status where there is one. ``fatal`` ones, as a missing key, fail the job."""

    def __init__(self, message: str, status: int | None = None, fatal: bool = False):
        super().__init__(message)
        self.status, self.fatal = status, fatal


class Provider(Protocol):
    """What answers frames: ``frame`` has the columns of a row; the answer is a JSON object."""

    def answer(self, frame: dict) -> str: ...


FACTORIES: dict[str, Callable[..., Provider]] = {}


def register(name: str, factory: Callable[..., Provider]) -> None:
    FACTORIES[name.strip().lower()] = factory


def provider(name: str, **options) -> Provider:
    """By name, in any case. Made on the driver once, to check it, and then in each task."""
    try:
        return FACTORIES[name.strip().lower()](**options)
    except KeyError:
        raise ValueError(f"unknown provider {name!r}; there are: {', '.join(sorted(FACTORIES)) or 'none'}") from None


def checked(text: str) -> dict:
    """The fields of ANSWER of an answer. Missing ones get their defaults, significance lies within 1 and 10; others of a wrong kind raise."""
    try:
        found = json.loads(text)
        if not isinstance(found, dict):
            raise TypeError("not an object")
        visual, unsure = ({k: part.get(k, default) for k, default in fields.items()} for part, fields in ((found.get("visual", {}), VISUAL), (found.get("uncertainty", {}), UNCERTAINTY)))
        out = visual | unsure | {"people_count": int(visual["people_count"]), "event_summary": str(found.get("event_summary", SUMMARY)), "plot_significance": max(1, min(10, int(found.get("plot_significance", SIGNIFICANCE))))}
        for k in ("character_labels", "objects"):
            if not isinstance(out[k], list):
                raise TypeError(f"{k} is no list")
            out[k] = [str(x) for x in out[k]]
        return out | {k: None if out[k] is None else str(out[k]) for k in ("location", "action", "emotion", "interaction", "visible_text", *UNCERTAINTY)}
    except (ValueError, TypeError, AttributeError) as error:
        raise ProviderError(f"answer doesn't fit: {error}") from error


def ask(of: Provider, frame: dict, tries: int, wait: float) -> tuple[dict | None, str | None, int]:
    """(answer, error, requests). After a transient status or a lost connection the next request comes n * ``wait`` seconds later; other errors are final."""
    error = None
    for n in range(1, tries + 1):
        try:
            return checked(of.answer(frame)), None, n
        except ProviderError as e:
            if e.fatal:
                raise
            error = str(e) if e.status is None else f"{e.status}: {e}"
            if e.status not in TRANSIENT:
                return None, error, n
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
        if n < tries:
            time.sleep(n * wait)
    return None, error, tries


def describe(frames: DataFrame, name: str, options: dict | None = None, tries: int = 3, wait: float = 2.0) -> DataFrame:
    """``frames`` with ``answer`` (struct), ``error`` and ``requests``; either of the first two is null. Store it before it is split.

    No order and no shuffle: rows stay where they are. Repeated rows are asked each by itself; empty input asks nothing.
    """
    make, columns = FACTORIES.get(name.strip().lower()), frames.columns
    provider(name, **(options or {}))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = make(**(options or {}))
        for pdf in batches:
            got = [ask(of, frame, tries, wait) for frame in pdf.to_dict("records")]
            yield pdf[columns].assign(answer=[a for a, _, _ in got], error=[e for _, e, _ in got], requests=[n for *_, n in got])

    kinds = ", ".join(f"`{c}` {kind}" for c, kind in frames.dtypes)
    return frames.mapInPandas(run, f"{kinds}, answer struct<{ANSWER.replace(' ', ':').replace(',:', ',')}>, error string, requests int")


def answers(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Those that were answered, without error, and the others, without answer, for another try."""
    return described.where("error IS NULL").drop("error"), described.where("error IS NOT NULL").drop("answer")


def worded(at: str, said: list[str], before: list[str]) -> str:
    """The prompt of a frame, as ``functions.scalars.prompt`` words it."""
    lines = lambda x, none: "\n".join(f"- {line}" for line in x) if x else none
    return f"Time: {at}\nDialogue:\n{lines(said, 'No dialogue.')}\nBefore:\n{lines(before, 'Nothing yet.')}"


def describe_in_order(frames: DataFrame, name: str, options: dict | None = None, done: DataFrame | None = None, most: int = 4, tries: int = 3, wait: float = 2.0) -> DataFrame:
    """movie_id, idx, prompt, answer, error: each frame is asked with the summaries of the ``most`` last answers before it in its movie.

    frames: movie_id string, idx long, at string, said array<string>. done: movie_id, idx, at, summary of frames answered by an earlier run, which aren't
    asked again but count as context. A movie's frames are sorted into one task and stream by; what is held are its last ``most`` summaries.
    A frame without an answer leaves no context. Repeated rows are asked each; null lines aren't said.
    """
    make = FACTORIES.get(name.strip().lower())
    provider(name, **(options or {}))
    rows = frames.select(F.col("movie_id").cast("string"), F.col("idx").cast("long"), "at", F.array_compact(F.coalesce("said", F.array().cast("array<string>"))).alias("said"), F.lit(None).cast("string").alias("summary"))
    if done is not None:
        known = done.select(F.col("movie_id").cast("string"), F.col("idx").cast("long"), "at", F.coalesce("summary", F.lit("")).alias("summary"))
        rows = rows.join(known.select("movie_id", "idx"), ["movie_id", "idx"], "left_anti").unionByName(known, allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, movie, before = make(**(options or {})), object(), deque(maxlen=most)
        for pdf in batches:
            out = []
            for here, idx, at, said, summary in pdf[["movie_id", "idx", "at", "said", "summary"]].itertuples(index=False):
                here = None if pd.isna(here) else here
                if here != movie:
                    movie, before = here, deque(maxlen=most)
                if summary is None or pd.isna(summary):
                    prompt = worded(at, list(said), list(before))
                    answer, error, _ = ask(of, {"movie_id": movie, "idx": idx, "prompt": prompt}, tries, wait)
                    out.append((movie, idx, prompt, answer, error))
                    summary = answer and answer["event_summary"]
                if summary is not None:
                    before.append(f"[{at}] {summary}")
            yield pd.DataFrame(out, columns=["movie_id", "idx", "prompt", "answer", "error"])

    kind = f"movie_id string, idx long, prompt string, answer struct<{ANSWER.replace(' ', ':').replace(',:', ',')}>, error string"
    return rows.repartition("movie_id").sortWithinPartitions("movie_id", "idx", "at").mapInPandas(run, kind)
