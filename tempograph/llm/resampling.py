"""Target-distribution importance resampling by a streaming CRC ring.

A document is scanned once. The ring holds the running zlib states of the last ``LONGEST`` word starts: each
new word extends every state by a space and the word, begins one of its own, and the oldest state falls
out, so that each step emits the buckets of all runs that end with this word without joining any text.

The buckets are stored; their counts, summed within tasks first, give each bucket's gain, and a document's
weight is the sum of its buckets' gains. What is broadcast are ``BUCKETS`` gains.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, in_frames, pieces, ranked, stored, table

LONGEST, BUCKETS, SHARE, LEAST, SEED = 3, 10_000, 5, 20, 42
#: Letters in lower case, other bytes that stand in no word as spaces.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def scan(text: str, longest: int = LONGEST, size: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to ``longest`` of them, by its last word."""
    ring, n, found = [], 0, []
    for piece in pieces(text.encode().translate(WORDS)):
        states = []
        words = piece.split()
        for word in words:
            more = b" " + word
            ring = [crc32(word), *[crc32(more, state) for state in ring[: longest - 1]]]
            states += ring
        n += len(words)
        found.append((np.array(states, np.uint32) % size).astype(np.min_scalar_type(size - 1)))
    return n, np.concatenate(found) if found else np.zeros(0, np.min_scalar_type(size - 1))


def bucket_rows(docs: DataFrame, longest: int = LONGEST, size: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, buckets (little-endian numbers) of every row."""

    def run(batches):
        for batch in batches:
            got = [scan(t or "", longest, size) for t in batch["text"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "n_words": [n for n, _ in got], "n_features": [len(b) for _, b in got], "buckets": [b.tobytes() for _, b in got]}

    return in_frames(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_counts(rows: DataFrame, size: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs. A task sends one row for each bucket that it met."""
    kind = np.min_scalar_type(size - 1)

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for b in batch["buckets"]:
                total += np.bincount(np.frombuffer(b.as_buffer(), kind), minlength=size)
        met = np.flatnonzero(total)
        yield {"bucket": met, "n": total[met]}

    out = np.zeros(size, object)
    for r in in_frames(rows.select("buckets"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, floor(1000 * ln of the smoothed target share over the smoothed source share), in doubles."""
    size, all_s, all_t = len(source), float(sum(source)), float(sum(target))
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_s + size) / ((float(s) + 1) * (all_t + size)))) for s, t in zip(source, target, strict=True)], np.int64)


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least: int = LEAST, seed: int = SEED, longest: int = LONGEST, size: int = BUCKETS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_features, weight, score, rank (null where not drawn).

    Of the rows with at least ``least`` words, ``share`` in a hundred are drawn, by score descending, then by id; rows that still tie (repeated
    ids, null ids, which come last) follow by features and weight, so that only equal rows are interchangeable. A null text has
    no words: weight 0, never drawn. Without rows nothing is drawn; other columns are ignored, whatever their names.
    """
    rows = stored(bucket_rows(docs, longest, size), "buckets")
    wanted = bucket_counts(in_frames(target.select("text"), lambda batches: ({"buckets": [scan(t or "", longest, size)[1].tobytes() for t in b["text"].to_pylist()]} for b in batches), "buckets binary"), size)
    gain, kind = gains(bucket_counts(rows, size), wanted), np.min_scalar_type(size - 1)

    def weigh(batches):
        for batch in batches:
            yield {c: batch[c] for c in ("doc_id", "n_words", "n_features")} | {"weight": [int(gain[np.frombuffer(b.as_buffer(), kind)].sum()) for b in batch["buckets"]]}

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    drawn_by = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = in_frames(rows, weigh, "doc_id long, n_words long, n_features long, weight long")
    scored = scored.select("doc_id", "n_features", "weight", (F.col("weight") + drawn_by).alias("score"), (F.col("n_words") >= least).alias("long_enough"))
    order = [F.desc("long_enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("weight")]
    draws = rows.where(F.col("n_words") >= least).count() * share // 100
    places = ranked(scored, order, [], "resampling")
    drop(rows)
    return places.select("doc_id", "n_features", "weight", "score", F.when(F.col("long_enough") & (F.col("rank") <= draws), F.col("rank")).alias("rank"))


def op12_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
