"""Interval joins and time grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import rounded


def interval_join(left: DataFrame, right: DataFrame, bucket: float, how: str = "inner", by: list[str] = ()) -> DataFrame:
    """Rows whose closed intervals [ls, le] and [rs, re] overlap, by an equi-join on time buckets.

    Each interval stands in every bucket that it touches. A pair is kept in the later of the two first
    buckets only, so that none comes twice and nothing has to be made distinct. ``by`` names further keys.
    Rows with a null bound or key match nothing; repeated rows match each by itself. With ``how="left"`` left rows
    without a match stay, with nulls.
    """
    spans = lambda df, s, e, f: df.withColumn(f, F.floor(F.col(s) / bucket)).withColumn("bucket", F.explode(F.sequence(f, F.floor(F.col(e) / bucket))))
    pairs = spans(left, "ls", "le", "lf").join(spans(right.where("rs <= re"), "rs", "re", "rf"), ["bucket", *by])
    pairs = pairs.where("rs <= le and re >= ls and bucket = greatest(lf, rf)").drop("bucket", "lf", "rf")
    if how == "inner":
        return pairs
    # Each copy of a left row has its own pairs; rows without any come by an anti join in which nulls are equal.
    pairs = pairs.select(*left.columns, *[c for c in right.columns if c not in by])
    met = pairs.select(*[F.col(c).alias(f"_met_{k}") for k, c in enumerate(left.columns)]).distinct()
    same = [left[c].eqNullSafe(met[f"_met_{k}"]) for k, c in enumerate(left.columns)]
    return pairs.unionByName(left.join(met, same, "left_anti"), allowMissingColumns=True)


def match_cues(frames: DataFrame, cues: DataFrame, window: float, bucket: float = 60.0, by: list[str] = ()) -> DataFrame:
    """Each frame (id, t) with the ordered ids of the cues (cue, rs, re) that touch [max(0, t - w), t + w]; unmatched frames keep an empty list."""
    left = frames.withColumns({"ls": F.greatest(F.lit(0.0), F.col("t") - window), "le": F.col("t") + window})
    pairs = interval_join(left, cues, bucket, by=by).groupBy(*by, "id").agg(F.array_sort(F.collect_list(F.struct("rs", "cue"))).alias("found"))
    return frames.join(pairs, [*by, "id"], "left").withColumn("cues", F.coalesce(F.transform("found", lambda c: c["cue"]), F.array().cast("array<bigint>"))).drop("found")


def time_grid(spans: DataFrame, interval: float) -> DataFrame:
    """Points 0, i, 2i ... up to the duration of each row, clamped, 3 decimals; a non-positive or null duration gives 0 alone. Repeated rows have a grid each."""
    last = F.when(F.col("duration") > 0, F.floor((F.col("duration") + 1e-4) / interval + 1e-9)).otherwise(0)
    return spans.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("t", rounded(F.greatest(F.lit(0.0), F.least(F.col("k") * interval, F.col("duration"))), 3))
