"""The stages as a graph of phases: what is missing is run, each phase's rows are counted while it is written, and a failure leaves its record."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.documents import staged
from . import stages as M

REPORT = "phase string, status string, rows long, seconds double, error string, needs array<string>"


@dataclass(frozen=True)
class Options:
    gap: float = 180.0
    expand: bool = False
    freezes: int = 0


@dataclass(frozen=True)
class Phase:
    """A table of its own: the tables it needs, inputs or phases, and how it comes from them."""

    name: str
    needs: tuple[str, ...]
    make: Callable[[dict[str, DataFrame], Options], DataFrame]
    shown: bool = field(default=True)


def _checked(t: dict[str, DataFrame]) -> DataFrame:
    return M.T.validate_clips(M.to_validate(t["clips"], t["headers"]))


#: In an order in which each phase stands behind what it needs.
GRAPH = [
    Phase("timeline", ("events", "characters", "appearances"), lambda t, o: M.with_cast(M.ordered(t["events"]), t["characters"], t["appearances"]), shown=False),
    Phase("headers", ("timeline", "movies"), lambda t, o: M.headers(t["timeline"], t["movies"]), shown=False),
    Phase("scenes", ("timeline",), lambda t, o: M.scenes(t["timeline"], o.gap)),
    Phase("beats", ("scenes",), lambda t, o: M.beats(t["scenes"])),
    Phase("causal_links", ("timeline",), lambda t, o: M.causal_links(t["timeline"])),
    Phase("arcs", ("timeline", "characters", "appearances"), lambda t, o: M.arcs(t["timeline"], t["characters"], t["appearances"])),
    Phase("leads", ("timeline", "characters", "appearances"), lambda t, o: M.leads(t["timeline"], t["characters"], t["appearances"])),
    Phase("story", ("headers", "scenes", "beats", "leads", "timeline"), lambda t, o: M.story(t["headers"], t["scenes"], t["beats"], t["leads"], M.ambiguous(t["timeline"]))),
    Phase("plan", ("headers", "beats", "causal_links"), lambda t, o: M.plan(t["headers"], t["beats"], t["causal_links"])),
    Phase("script", ("plan", "scenes", "timeline", "headers"), lambda t, o: M.script(t["plan"], t["scenes"], t["timeline"], t["headers"])),
    Phase("script_totals", ("script", "headers"), lambda t, o: M.script_totals(t["script"], t["headers"])),
    Phase("clips", ("script", "scenes", "timeline", "headers"), lambda t, o: M.clips(t["script"], t["scenes"], t["timeline"], t["headers"], o.expand)),
    Phase("clip_totals", ("clips", "headers"), lambda t, o: M.clip_totals(t["clips"], t["headers"])),
    Phase("validation", ("clips", "headers"), lambda t, o: _checked(t).select("movie_id", "clip_id", "valid", "errors", "warnings")),
    Phase("plan_validation", ("clips", "clip_totals", "headers"), lambda t, o: M.T.validate_plans(t["clip_totals"], _checked(t))),
    Phase("items", ("script", "clips"), lambda t, o: M.items(t["script"], t["clips"], o.freezes)),
    Phase("manifest", ("items",), lambda t, o: M.manifest(t["items"])),
    Phase("captions", ("script", "items"), lambda t, o: M.captions(t["script"], t["items"])),
    Phase("summary", ("headers", "characters", "scenes", "clips", "items"), lambda t, o: M.summary(t["headers"], t["characters"], t["scenes"], t["clips"], t["items"], t.get("merges"))),
]
PHASES = {p.name: p for p in GRAPH}


def needed(names: Iterable[str]) -> list[Phase]:
    """The phases of these names and all that they need, in order."""
    wanted = set()

    def add(name: str) -> None:
        if name in PHASES and name not in wanted:
            wanted.add(name)
            for need in PHASES[name].needs:
                add(need)

    for name in names:
        if name not in PHASES:
            raise ValueError(f"no phase {name!r}; there are: {', '.join(PHASES)}")
        add(name)
    return [p for p in GRAPH if p.name in wanted]


def _there(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def run(spark: SparkSession, inputs: dict[str, DataFrame], target: str, want: Iterable[str] | None = None, options: Options | None = None, force: bool = False, dry_run: bool = False) -> list[dict]:
    """Run the phases in ``want``, by default all, into Parquet tables below ``target``; the report, also written to ``target``/report.

    Of each phase: SUCCESS, DRY_RUN (counted, not kept), REUSED (its table was there, and all that it needs were reused too), FAILED with the error, or
    SKIPPED where one that it needs failed. ``force`` runs all of ``want`` and what they need again. Rows are counted by the job that writes them.
    """
    tables, records, fate, options = dict(inputs), [], {}, options or Options()
    for phase in needed(want if want is not None else PHASES):
        path, began = f"{target.rstrip('/')}/{phase.name}", time.time()
        record = {"phase": phase.name, "status": "SUCCESS", "rows": None, "seconds": 0.0, "error": None, "needs": list(phase.needs)}
        before = {fate.get(need, "REUSED") for need in phase.needs}
        try:
            if before & {"FAILED", "SKIPPED"}:
                record["status"], record["error"] = "SKIPPED", ", ".join(n for n in phase.needs if fate.get(n) in ("FAILED", "SKIPPED"))
            elif not (force or dry_run) and before == {"REUSED"} and _there(spark, path):
                record["status"], tables[phase.name] = "REUSED", spark.read.parquet(path)
            else:
                seen = Observation()
                made = phase.make(tables, options)
                counted = made.observe(seen, F.count(F.lit(1)).alias("rows"))
                if dry_run:
                    tables[phase.name] = staged(counted, phase.name)
                    record["status"] = "DRY_RUN"
                else:
                    counted.write.mode("overwrite").parquet(path)
                    tables[phase.name] = spark.read.schema(made.schema).parquet(path)
                record["rows"] = seen.get["rows"]
        except Exception as error:  # noqa: BLE001  whatever it is, it ends in the report
            record["status"], record["error"] = "FAILED", (str(error).strip() or traceback.format_exc(limit=-1)).splitlines()[0]
        record["seconds"] = round(time.time() - began, 3)
        fate[phase.name] = record["status"]
        records.append(record)
    if not dry_run:
        spark.createDataFrame([tuple(r.values()) for r in records], REPORT).coalesce(1).write.mode("overwrite").json(f"{target.rstrip('/')}/report")
    return records


def failed(records: list[dict]) -> list[dict]:
    return [r for r in records if r["status"] == "FAILED"]


def derive(events: DataFrame, characters: DataFrame, appearances: DataFrame, movies: DataFrame, gap: float = 180.0, expand: bool = False, freezes: int = 0, merges: DataFrame | None = None) -> dict[str, DataFrame]:
    """All shown phases' tables by name, without a target. What others need is stored in the shared folder."""
    tables = {"events": events, "characters": characters, "appearances": appearances, "movies": movies} | ({} if merges is None else {"merges": merges})
    options, used = Options(gap, expand, freezes), {need for p in GRAPH for need in p.needs}
    for p in GRAPH:
        made = p.make(tables, options)
        tables[p.name] = staged(made, p.name) if p.name in used else made
    return {p.name: tables[p.name] for p in GRAPH if p.shown}
