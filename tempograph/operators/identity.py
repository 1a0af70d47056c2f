"""Evidence of names, merging of identities, and the descriptions of a provider that makes them up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .timeline import vote


def resolve_merges(characters: DataFrame, merges: DataFrame) -> DataFrame:
    """Where each character ends: movie_id, character_id, root.

    merges: movie_id, idx, primary, merged, applied in the order of idx. A merge of an id with itself, or of
    one that isn't there (any more), does nothing. The characters and merges of one movie are few.
    """
    ids = characters.groupBy("movie_id").agg(F.collect_set("character_id").alias("ids"))
    steps = merges.groupBy("movie_id").agg(F.array_sort(F.collect_list(F.struct("idx", "primary", "merged"))).alias("steps"))
    df = ids.join(steps, "movie_id", "left")
    start = F.transform("ids", lambda i: F.struct(i.alias("id"), i.alias("root")))
    alive = lambda acc, i: F.exists(acc, lambda x: (x["id"] == i) & (x["root"] == i))

    def step(acc, m):
        moved = F.transform(acc, lambda x: F.struct(x["id"].alias("id"), F.when(x["root"] == m["merged"], m["primary"]).otherwise(x["root"]).alias("root")))
        return F.when((m["primary"] != m["merged"]) & alive(acc, m["primary"]) & alive(acc, m["merged"]), moved).otherwise(acc)

    folded = F.when(F.col("steps").isNull(), start).otherwise(F.aggregate("steps", start, step))
    return df.select("movie_id", F.explode(folded).alias("x")).select("movie_id", F.col("x.id").alias("character_id"), "x.root")


def merge_identities(characters: DataFrame, merges: DataFrame) -> DataFrame:
    """Spans of merged characters. characters: movie_id, character_id, first_seen, last_seen."""
    roots = resolve_merges(characters, merges)
    spans = characters.join(roots, ["movie_id", "character_id"]).groupBy("movie_id", "root")
    return spans.agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.array_sort(F.collect_set("character_id")).alias("merged_ids")).withColumnRenamed("root", "character_id")


def vote_again(evidence: DataFrame, roots: DataFrame) -> DataFrame:
    """The name vote of each merged character, over the evidence of all that it took in. evidence: movie_id, character_id, candidate, confidence, idx."""
    key = F.to_json(F.struct("movie_id", "root"))
    votes = vote(evidence.join(roots, ["movie_id", "character_id"]).select(key.alias("movie_id"), "candidate", "confidence", "idx"))
    whole = roots.select("movie_id", F.col("root").alias("character_id"), key.alias("_k")).distinct()
    return whole.join(votes.withColumnRenamed("movie_id", "_k"), "_k").drop("_k")


def mock_description(cues, at):
    """What the deterministic provider says of a frame with these cues (array of strings) at this time (string)."""
    said = F.size(cues) > 0
    labels = F.when(said, F.array(F.lit("PERSON_A"), F.lit("PERSON_B"))).otherwise(F.array(F.lit("PERSON_A")))
    return F.struct(
        F.when(said, 2).otherwise(1).alias("people_count"),
        labels.alias("character_labels"),
        F.when(said, F.concat(F.lit('Characters speaking: "'), F.array_join(F.slice(cues, 1, 2), " "), F.lit('"'))).otherwise("A character is observing the surroundings.").alias("action"),
        F.when(said, F.concat(F.lit('Characters interact while discussing: "'), F.get(cues, F.lit(0)), F.lit('"'))).otherwise(F.concat(F.lit("Scene progression at "), at, F.lit(" showing character observation."))).alias("event_summary"),
        F.when(said, 6).otherwise(4).alias("plot_significance"),
    )


def name_evidence(events: DataFrame) -> DataFrame:
    """movie_id, idx, label, line, at, sec, text, candidate, speaker, confidence: names said near events, given to the first label seen.

    events: movie_id, idx, sec, labels, dialogue (array of start_seconds, text, speaker). A line's speaker counts 0.90, unless a disallowed name; names in its text
    count 0.80, as does the last word of one of several words. Of a label's evidence of one text and candidate the first stays. Events without labels give none.
    """
    line = F.posexplode("dialogue").alias("line", "d")
    e = events.select("movie_id", "idx", "sec", F.get("labels", F.lit(0)).alias("label"), line).where("label IS NOT NULL")
    text, speaker = F.coalesce("d.text", F.lit("")), F.nullif(S.strip(F.col("d.speaker")), F.lit(""))
    tag = F.when(speaker.isNotNull() & ~speaker.isin(S.NO_NAMES), F.struct(F.concat(F.lit("[Speaker Tag: "), speaker, F.lit("] "), text).alias("text"), speaker.alias("candidate"), F.lit(0.90).alias("confidence")))
    said = F.transform(S.name_evidence(text), lambda n: F.struct(text.alias("text"), n.alias("candidate"), F.lit(0.80).alias("confidence")))
    each = F.posexplode(F.concat(F.array_compact(F.array(tag)), said)).alias("at", "x")
    rows = e.select("movie_id", "idx", "label", "line", F.coalesce("d.start_seconds", "sec").alias("sec"), speaker.alias("speaker"), each).select("movie_id", "idx", "label", "line", "at", "sec", "speaker", "x.*")
    best = rows.groupBy("movie_id", "label", "text", "candidate").agg(F.min(F.struct("idx", "line", "at", "sec", "speaker", "confidence")).alias("b"))
    return best.select("movie_id", "b.idx", "label", F.col("b.line").alias("line"), F.col("b.at").alias("at"), "b.sec", "text", "candidate", "b.speaker", "b.confidence")


def seen(events: DataFrame) -> DataFrame:
    """Events in which someone is: labels as given, or made for the people counted; events with neither go."""
    labels = S.person_labels(F.col("people_count"), F.col("labels"))
    return events.withColumn("labels", labels).where(F.size("labels") > 0)
