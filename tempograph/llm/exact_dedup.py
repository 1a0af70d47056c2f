"""Exact deduplication by skew-safe combining.

Three stages, each comparing the full normalised text as part of its grouping key:

1. local: the map side of the first aggregation collapses equal texts of one task;
2. salted: groups of (digest, salt, text) meet, so that a hot text spreads over ``SALTS`` tasks;
3. global: the at most ``SALTS`` salt winners of a text meet.

Rows then find their group by (digest, salt), without carrying texts a third time; a digest that two
different texts share stops the job, since the winners' texts were compared in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few, lower_ascii, stored, table, whole_text

SALTS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. A null text counts as empty. The row with the
    largest id stays; null ids stay only in groups without any other id. Of repeated rows with that id and
    text, one is kept. Empty input gives no rows. Other columns, whatever their names, are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), lower_ascii(whole_text(F.col(text_col))).alias("norm")).select(
        "doc_id", "norm", F.sha2("norm", 256).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")
    )
    salted = rows.groupBy("digest", "salt", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    winners = (
        salted.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"))
        .select("digest", "keep_id", "group_size", "mask", F.count(F.lit(1)).over(Window.partitionBy("digest")).alias("texts"))
        .select(
            "digest",
            "keep_id",
            F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("group_size"),
            F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> shiftrightunsigned(mask, s) & 1 = 1)")).alias("salt"),
        )
    )
    members = rows.select("doc_id", "digest", "salt").repartition("digest", "salt").groupBy("digest", "salt", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    return (
        members.join(winners, ["digest", "salt"])
        .select("doc_id", "keep_id", "group_size", F.col("digest").alias("text_sha256"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, one for each distinct text.

    What is joined are the dropped rows' ids and digests; texts aren't shuffled again. Of repeated rows of
    one id and text, one stays.
    """
    out = stored(exact_groups(docs).where("not kept").select(F.col("doc_id").alias("_i"), F.col("keep_id").alias("_k"), F.col("text_sha256").alias("_d")), "dropped")
    same_id = F.col("_i").eqNullSafe(F.col("_k"))
    match = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_d"))
    keyed = docs.withColumns({"_id": F.col("doc_id"), "_digest": F.sha2(lower_ascii(whole_text(F.col("text"))), 256)})
    left = keyed.join(few(out.where(~same_id).drop("_k")), match, "left_anti")
    twice = out.where(same_id).drop("_k").distinct()
    if not twice.isEmpty():
        left = left.join(few(twice), match, "left_anti").unionByName(left.join(few(twice), match, "left_semi").dropDuplicates(["_id", "_digest"]))
    return left.select(docs.columns)


def op10_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS rn FROM n
)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(t) AS text_sha256 FROM w
"""
