"""Windows and aggregations over ordered timelines: every operator works within one movie, by its ordinal."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import padded_id, rounded
from . import keylists


def order():
    """A movie's rows by their ordinal; made when asked for, since a window needs a session."""
    return Window.partitionBy("movie_id").orderBy("idx")


def rolling_context(df: DataFrame, line: str, most: int = 4) -> DataFrame:
    """``df`` with ``context``, the lines of the ``most`` rows before, oldest first; null lines are left out. Rows of one ordinal follow in no defined order."""
    return df.withColumn("context", F.collect_list(line).over(order().rowsBetween(-most, -1)))


def sessionize(df: DataFrame, new: Column, cap: int = 6) -> DataFrame:
    """Scene numbers from 1: a scene starts where ``new`` holds or is null, as for a movie's first event, and where it already has ``cap`` events. Rows of one ordinal share their scene; a null movie is one movie."""
    runs = df.withColumn("run", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(order()))
    runs = runs.withColumn("piece", F.floor((F.row_number().over(Window.partitionBy("movie_id", "run").orderBy("idx")) - 1) / cap))
    starts = (F.col("run") != F.lag("run", 1, -1).over(order())) | (F.col("piece") != F.lag("piece", 1, -1).over(order()))
    return runs.withColumn("scene", F.sum(starts.cast("int")).over(order()).cast("int")).drop("run", "piece")


def by_gap(limit: float) -> Column:
    """Whether more than ``limit`` seconds lie between an event and the one before; null for the first one, and where a time is null."""
    return F.col("sec") - F.lag("sec").over(order()) > limit


def modes(df: DataFrame, keys: list[str], value: str, by: str) -> DataFrame:
    """The most frequent value of each group; of equal ones, the one that comes first. A null value counts as a value; repeated rows count each."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(by).alias("first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def scene_records(events: DataFrame) -> DataFrame:
    """Of scenes: start, end (last time + 30), indices, labels, place (mode), importance. Null labels are left out; repeated rows count each; no rows give no scenes."""
    keys = ["movie_id", "scene"]
    base = events.groupBy(*keys).agg(
        F.min_by("sec", "idx").alias("start_seconds"),
        (F.max_by("sec", "idx") + 30).alias("end_seconds"),
        F.array_sort(F.collect_list("idx")).alias("event_indices"),
        F.array_sort(F.collect_set("label")).alias("characters"),
        F.max("sig").alias("importance"),
    )
    return base.join(modes(events, keys, "label", "idx").withColumnRenamed("label", "location"), keys)


APPEND_FROM, APPEND_TO = ["SETUP", "DISCOVERY"], ["SETUP", "DISCOVERY", "REVEAL"]
TENSION = ["CONFLICT", "ESCALATION", "RESOLUTION"]


def beats(df: DataFrame, function: str = "function") -> DataFrame:
    """Cluster numbers of adjacent scenes by their functions, the two-state rule in closed form.

    A pair of alike functions appends and makes the cluster long; a first INTRODUCTION starts one; any other
    scene starts one if the cluster is long, else it appends and makes it long. So the state at an "other" is
    the parity of the others since the last scene of another kind.
    """
    s, p = F.col(function), F.lag(function).over(order())
    alike = (p.isin(APPEND_FROM) & s.isin(APPEND_TO)) | (p.isin(TENSION) & s.isin(TENSION))
    kind = F.when(p.isNull(), "c").when(alike, "a").when((s == "INTRODUCTION") & (p != "INTRODUCTION"), "c").otherwise("d")
    df = df.withColumn("_kind", kind).withColumn("_run", F.sum((F.col("_kind") != "d").cast("int")).over(order()))
    run = Window.partitionBy("movie_id", "_run").orderBy("idx")
    df = df.withColumn("_nth", F.row_number().over(run) - 1).withColumn("_head", F.first("_kind").over(run))
    starts = (F.col("_kind") == "c") | ((F.col("_kind") == "d") & (F.when(F.col("_head") == "a", F.col("_nth") % 2 == 1).otherwise(F.col("_nth") % 2 == 0)))
    return df.withColumn("beat", F.sum(starts.cast("int")).over(order()).cast("int")).drop("_kind", "_run", "_nth", "_head")


def identities(df: DataFrame, label: str = "label") -> DataFrame:
    """Labels numbered by first appearance, with first and last sighting by ordinal. Labels that appear at once go by name; a null label is a label; repeated rows count as appearances."""
    seen = df.groupBy("movie_id", label).agg(F.min("idx").alias("first_idx"), F.min_by("sec", "idx").alias("first_seen"), F.max_by("sec", "idx").alias("last_seen"), F.count(F.lit(1)).alias("appearances"))
    return seen.withColumn("character_id", padded_id("CHARACTER", F.row_number().over(Window.partitionBy("movie_id").orderBy("first_idx", label))))


#: Rows of one side that a task expands into pairs.
PAIRED = 250_000


def _parts(df: DataFrame) -> int:
    """Partitions for rows that are expanded into pairs: by their number, since the size before says little of the size after."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / PAIRED))


def edges(df: DataFrame, key: str, member: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Ordered pairs of different members of one event; of each pair its first event. ``by`` names further keys of an event, as its movie.

    Repeated rows count once; a null key, event or member is in no pair. An event's members are gathered in one array.
    """
    rows = df.select(*by, key, F.col(member).alias("_m")).dropna()
    events = rows.repartition(_parts(rows), *by, key).groupBy(*by, key).agg(F.collect_set("_m").alias("_m"))
    pairs = events.select("*", F.explode("_m").alias("source")).select(*by, key, "source", F.explode("_m").alias("target"))
    return pairs.where("source <> target").groupBy(*by, "source", "target").agg(F.min(key).alias("first_event"))


def vote(evidence: DataFrame) -> DataFrame:
    """The candidate of most evidence, then of highest confidence, then the first; and how sure that is. A null confidence counts as none, a null candidate as a candidate; repeated evidence counts each."""
    c = evidence.groupBy("movie_id", "candidate").agg(F.count(F.lit(1)).alias("votes"), F.max("confidence").alias("top"), F.min("idx").alias("first"))
    best = c.groupBy("movie_id").agg(F.max_by(F.struct("candidate", "votes", "top"), F.struct("votes", "top", -F.col("first"))).alias("b")).select("movie_id", "b.*")
    level = F.when(F.col("votes") >= 2, "high").when(F.col("top") >= 0.85, "medium").when(F.col("top") >= 0.60, "low").otherwise("unknown")
    return best.withColumn("name_confidence", level).withColumn("name", F.when(level != "unknown", F.col("candidate"))).drop("candidate")


def first_of(df: DataFrame, keys: list[str], order: str = "idx") -> DataFrame:
    """Of each group of keys, nulls being a key, the row that comes first in ``order``; of equal ones any."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


#: Names that earn no bonus.
NO_BONUS = ("leaving", "unknown")


def ranked_leads(df: DataFrame, name: str, first: str) -> DataFrame:
    """screen_ratio, score and rank of rows (movie_id, n, events, span, duration, mean_sig).

    0.40 share of events + 0.30 share of time + 0.20 significance + 0.10 for a name, in 0..1, 3 decimals; ties go to more events, then to the lowest ``first``.
    """
    df = df.withColumn("screen_ratio", rounded(F.greatest(F.lit(0.0), F.col("span")) / F.greatest(F.lit(1.0), F.col("duration")), 3))
    named = F.coalesce((F.col(name) != "") & ~F.lower(name).isin(*NO_BONUS), F.lit(False))
    score = 0.40 * F.col("n") / F.col("events") + 0.30 * F.col("screen_ratio") + 0.20 * F.least(F.lit(1.0), F.coalesce("mean_sig", F.lit(5.0)) / 10.0) + F.when(named, 0.10).otherwise(0.0)
    df = df.withColumn("score", rounded(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 3))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("movie_id").orderBy(F.desc("score"), F.desc("n"), first)))


def prominence(df: DataFrame, label: str = "label") -> DataFrame:
    """Leads among the labels of events (movie_id, idx, sec, sig), where every event has a label and a label is a name."""
    whole = df.groupBy("movie_id").agg(F.countDistinct("idx").alias("events"), F.max("sec").alias("duration"))
    own = df.groupBy("movie_id", label).agg(F.countDistinct("idx").alias("n"), (F.max("sec") - F.min("sec")).alias("span"), F.sum("sig").alias("sig"), F.count(F.lit(1)).alias("k"), F.min("idx").alias("first"))
    return ranked_leads(own.join(whole, "movie_id").withColumn("mean_sig", F.col("sig") / F.col("k")), label, "first")


def coverage(n: Column, samples: Column, reached: Column, duration: Column) -> Column:
    """COMPLETE from 85 % of the samples if their number is known, else from 80 % of the time; else PARTIAL."""
    done = F.when(samples > 0, n >= F.floor(samples * 0.85)).when(duration > 0, reached >= duration * 0.80).otherwise(False)
    return F.when((n > 0) & done, "COMPLETE").otherwise("PARTIAL")


def target_seconds(ratio: Column, complete: Column) -> Column:
    return F.when(complete, 900.0).otherwise(F.greatest(F.lit(45.0), F.least(900.0 * ratio * 1.25, F.lit(900.0))))


def allocate(df: DataFrame, weight: str, target: str, floor: float = 10.0) -> DataFrame:
    """Shares of the target by weight, at least ``floor``, rescaled to the target, 1 decimal at both steps. Weights are decimals, so sums are exact."""
    w = Window.partitionBy("movie_id")
    share = rounded(F.greatest(F.lit(floor), F.col(weight).cast("double") / F.sum(weight).over(w).cast("double") * F.col(target)), 1).cast("decimal(18,1)")
    df = df.withColumn("_share", share)
    return df.withColumn("seconds", rounded(F.col("_share").cast("double") * F.col(target) / F.sum("_share").over(w).cast("double"), 1)).drop("_share")


def clip_budget(importance: Column, n: Column) -> Column:
    return F.when(importance >= 7, F.when(n <= 1, 1).otherwise(F.least(F.lit(3), n))).when(importance >= 4, F.least(F.lit(2), n)).otherwise(1)


def subsample(df: DataFrame, keys: list[str], order: str, k: Column) -> DataFrame:
    """Of n ordered rows, those at floor(i n / k) for i < k; a k above n takes all, one of 0 or null none. Repeated rows count each."""
    df = df.withColumns({"_p": F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1, "_c": F.count(F.lit(1)).over(Window.partitionBy(*keys))}).withColumn("_k", F.least(k.cast("int"), F.col("_c").cast("int")))
    here = F.exists(F.sequence(F.lit(0), F.col("_k") - 1), lambda i: F.floor(i * F.col("_c") / F.col("_k")) == F.col("_p"))
    return df.where(F.when(F.col("_k") > 0, here).otherwise(False)).drop("_p", "_c", "_k")


def or_all(df: DataFrame, keys: list[str], good: Column) -> DataFrame:
    """Rows that qualify, or all rows of a group in which none does; a null condition doesn't qualify."""
    df = df.withColumn("_g", F.coalesce(good, F.lit(False))).withColumn("_any", F.max("_g").over(Window.partitionBy(*keys)))
    return df.where("_g or not _any").drop("_g", "_any")


def layout(items: DataFrame) -> DataFrame:
    """Start and end of items on a timeline, from exact decimal durations. A null duration takes no time, its end is the last one's, its start null."""
    end = F.sum("duration").over(order().rowsBetween(Window.unboundedPreceding, 0))
    return items.withColumn("end_seconds", end).withColumn("start_seconds", F.col("end_seconds") - F.col("duration"))


def validate_clips(clips: DataFrame, longest: float = 3.0, apart: float = 5.0) -> DataFrame:
    """Errors and warnings of clips (movie_id, idx, clip_id, start, stop, duration, event, scene, reason, movie_end, pushed), by clip.

    What concerns two adjacent clips stands at the second. A pair of which either clip was ``pushed`` may be close, but may not overlap.
    Of clips with one id all but the first are wrong. A null id, scene or reason counts as empty, a null event as 0, a null ``pushed``
    as false; other nulls meet no rule.
    """
    gap = F.col("start") - F.lag("stop").over(order())
    free = ~(F.coalesce("pushed", F.lit(False)) | F.coalesce(F.lag("pushed").over(order()), F.lit(False)))
    rule = lambda cond, code: F.when(cond, F.lit(code))
    nameless = F.coalesce("clip_id", F.lit("")) == ""
    errors = [
        rule(nameless, "empty_id"),
        rule(~nameless & (F.row_number().over(Window.partitionBy("movie_id", "clip_id").orderBy("idx")) > 1), "duplicate_id"),
        rule(F.col("duration") <= 0, "no_duration"),
        rule(F.col("duration") > longest + 0.01, "too_long"),
        rule(F.col("start") < 0, "negative_start"),
        rule(F.col("stop") <= F.col("start"), "end_before_start"),
        rule(F.abs(F.col("duration") - rounded(F.col("stop") - F.col("start"), 2)) > 0.15, "duration_mismatch"),
        rule((F.col("movie_end") > 0) & (F.col("stop") > F.col("movie_end") + 1.0), "past_end"),
        rule(F.coalesce("event", F.lit(0)) <= 0, "no_event"),
        rule(F.coalesce("scene", F.lit("")) == "", "no_scene"),
        rule(gap < 0, "overlap"),
        rule((gap >= 0) & (gap < 0.5) & free, "touching"),
    ]
    warnings = [rule(F.coalesce("reason", F.lit("")) == "", "no_reason"), rule((gap >= 0.5) & (gap < apart) & free, "close"), rule(F.lag("start").over(order()) - F.col("start") > 5, "backwards")]
    return clips.withColumns({"errors": F.array_compact(F.array(*errors)), "warnings": F.array_compact(F.array(*warnings))}).withColumn("valid", F.size("errors") == 0)


def validate_plans(plans: DataFrame, checked: DataFrame) -> DataFrame:
    """movie_id, errors, warnings (how many), valid: one row for each plan (movie_id, total_clips) over its validated clips.

    A plan that reports clips but has none is wrong. Without either it is valid; a null total counts as 0.
    """
    own = checked.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("errors")).alias("e"), F.sum(F.size("warnings")).alias("w"))
    none = ((F.coalesce("n", F.lit(0)) == 0) & (F.coalesce("total_clips", F.lit(0)) > 0)).cast("long")
    df = plans.select("movie_id", "total_clips").join(own, "movie_id", "left").select("movie_id", (F.coalesce("e", F.lit(0)) + none).alias("errors"), F.coalesce("w", F.lit(0)).alias("warnings"))
    return df.withColumn("valid", F.col("errors") == 0)


def metrics(items: DataFrame) -> DataFrame:
    """Counts and seconds by item type, and the share of moving footage. Null durations and other types take part in the total only; a movie without items has no row."""
    part = lambda kind: F.coalesce(F.sum(F.when(F.col("item_type") == kind, F.col("duration"))), F.lit(0).cast("decimal(12,2)"))
    m = items.groupBy("movie_id").agg(F.count_if(F.col("item_type") == "SOURCE_CLIP").alias("clips"), part("SOURCE_CLIP").alias("footage"), part("STILL_FREEZE").alias("freeze"), part("BLACK_TRANSITION").alias("black"), F.sum("duration").alias("total"))
    return m.withColumn("moving_percent", rounded(F.col("footage").cast("double") / F.greatest(F.lit(0.01), F.col("total").cast("double")) * 100, 1))


def causal_pairs(df: DataFrame, most: int = 3) -> DataFrame:
    """Consecutive pairs, at most ``most`` of each movie; a pair whose effect is null is left out but counts."""
    pairs = df.withColumns({"effect": F.lead("title").over(order()), "effect_idx": F.lead("idx").over(order()), "_n": F.row_number().over(order())})
    return pairs.where((F.col("_n") <= most) & F.col("effect").isNotNull()).drop("_n")


def overlap_join(a: DataFrame, b: DataFrame, item: str) -> DataFrame:
    """Keys of rows whose item lists overlap. A null item meets nothing; repeated rows count once.

    Each range of the keys of ``a`` gets an item's keys of ``b`` as one array, and the arrays of a key are united there, so pairs of keys are
    neither shuffled nor compared with all others. What one key of ``a`` meets is held in one array. Where item and keys are whole numbers,
    the arrays are packed lists (``keylists``), which each key of ``a`` gets.
    """
    left, right = [c for c in a.columns if c != item], [c for c in b.columns if c != item]
    rows = a.where(F.col(item).isNotNull())
    parts = _parts(rows)
    kinds, others = dict(a.dtypes), dict(b.dtypes)
    if len(left) == len(right) == 1 and {*kinds.values(), *others.values()} <= {"tinyint", "smallint", "int", "bigint"}:
        whole = b.where(F.col(item).isNotNull()).select(F.col(item).cast("long").alias("_item"), F.col(right[0]).cast("long").alias("_b"))
        lists = whole.repartition(parts, "_item").sortWithinPartitions("_item", "_b").mapInArrow(keylists.pack, "_item long, _list binary")
        mine = rows.select(F.col(item).cast("long").alias("_item"), F.col(left[0]).cast("long").alias("_a")).repartition(parts, "_item").distinct()
        met = mine.join(lists.hint("merge"), "_item").select("_a", "_list").repartition(parts, "_a").sortWithinPartitions("_a")
        pairs = met.mapInArrow(keylists.unpack, "_a long, _b long")
        return pairs.select(F.col("_a").cast(kinds[left[0]]).alias(left[0]), F.col("_b").cast(others[right[0]]).alias(right[0]))
    ranges = rows.repartitionByRange(parts, *left).withColumn("_range", F.spark_partition_id())
    mine = ranges.groupBy("_range", item).agg(F.collect_set(F.struct(*left)).alias("_a"))
    theirs = b.groupBy(item).agg(F.collect_set(F.struct(*right)).alias("_b"))
    met = mine.join(theirs.hint("merge"), item).select("_range", "_a", "_b")
    met = met.repartition(parts, "_range").select("_range", F.explode("_a").alias("_a"), "_b")
    if len(right) > 1:  # arrays of structs are made distinct by comparing all with all
        return met.select("_range", "_a", F.inline("_b")).distinct().select("_a.*", *right)
    each = met.select("_range", "_a", F.col("_b")[right[0]].alias("_b")).groupBy("_range", "_a").agg(F.array_distinct(F.flatten(F.collect_list("_b"))).alias("_b"))
    return each.select("_a.*", F.explode("_b").alias(right[0]))


def neighbour_fill(x: Column) -> Column:
    return F.coalesce(x, F.lag(x).over(order()), F.lead(x).over(order()))


def ordinal_max(x: Column) -> Column:
    rank = F.max(F.when(x == "high", 3).when(x == "medium", 2).otherwise(1))
    return F.when(rank == 3, "high").when(rank == 2, "medium").otherwise("low")


def ordered_distinct(value: str, order: str = "idx") -> Column:
    return F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value])), " ")


def pending(frames: DataFrame, done: DataFrame, limit: int | None = None, force: bool = False) -> DataFrame:
    """Frames still to be processed: the prefix limit applies first, per movie; ``force`` takes all of these. Frames with a null key are never done; repeated rows stay."""
    if limit and limit > 0:
        frames = frames.withColumn("_n", F.row_number().over(order())).where(F.col("_n") <= limit).drop("_n")
    return frames if force else frames.join(done.select("movie_id", "idx"), ["movie_id", "idx"], "left_anti")


def missing_files(frames: DataFrame, files: DataFrame, force: bool = False) -> DataFrame:
    """Frames whose file (``path``) isn't there or is empty. files: path, length, as a listing has them. A null path is missing; ``force`` takes all."""
    there = files.where("length > 0").select(F.col("path").alias("_path")).distinct()
    return frames if force else frames.join(there, F.col("path") == F.col("_path"), "left_anti")


def choose_track(tracks: DataFrame, keys: list[str], rules: list[Column], order: list[str]) -> DataFrame:
    """Of each group the row that meets the earliest rule; of several, the first in order. A null rule isn't met; rows that meet none come last."""
    score = F.lit(len(rules))
    for k, r in reversed(list(enumerate(rules))):
        score = F.when(r, k).otherwise(score)
    return tracks.withColumn("rule", score.cast("int")).withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("rule", *order))).where("_n = 1").drop("_n")
