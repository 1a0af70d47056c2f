"""Importance resampling against brute force, and the ring against joined runs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tempograph.llm import resampling
from tests.llm.test_operators import SCHEMA, SF, TEXTS, low

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(low(text))
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def brute(rows, target):
    s, t = (Counter(bucket(f) for text in texts for f in features(text)[1]) for texts in ([r["text"] for r in rows], target))
    all_s, all_t, out = sum(s.values()), sum(t.values()), []
    for r in rows:
        w, fs = features(r["text"])
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"42:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:8], 16)
        out.append([r["doc_id"], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    long_enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[2]))
    for k, r in enumerate(long_enough[: 5 * len(long_enough) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("text", ["", " ", "a", "A b", "É日 x-Y 1.2", "aa " * 50, "x" * 10, "w v " * 700_000])
def test_ring_equals_joined_runs(text):
    n, got = resampling.scan(text)
    w, fs = features(text)
    assert n == len(w) and sorted(got.tolist()) == sorted(map(bucket, fs))


def test_ring_of_other_lengths():
    w = "a bc d a bc d e".split()
    assert Counter(resampling.scan(" ".join(w), 5, 1 << 20)[1].tolist()) == Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % (1 << 20) for k in range(1, 6) for i in range(len(w) - k + 1))


def test_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted((tuple(r) for r in resampling.op12_resampling(spark, SF).collect()), key=str) == brute(rows, target)


def test_awkward_rows(spark):
    same = "one two three four five six seven eight nine ten " * 3
    rows = [(k, t, "en", "s", 1, "clash", 3, "no") for k, t in enumerate(TEXTS)] + [(7, same, None, None, None, None, None, None)] * 30 + [(None, same, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([("one two three", 1), (None, 2), ("", 3)], "text string, rank int")
    got = resampling.resample(docs, target).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs.collect(), ["one two three"])
    assert sorted(r["rank"] for r in got if r["rank"]) == [1]
    assert resampling.resample(docs.where("false"), target).count() == 0
    assert {r["weight"] > 0 for r in resampling.resample(docs.where("doc_id = 7"), target.where("false")).collect()} == {False}


def test_gain_of_equal_shares_is_nothing():
    assert (resampling.gains(np.zeros(10, object), np.zeros(10, object)) == 0).all()


def test_rank_over_many_ranges(spark):
    """Ranks go on over ranges, with many ties."""
    from pyspark.sql import functions as F

    from tempograph.llm.common import ranked

    rows = spark.range(5000).select((F.col("id") % 7).alias("g"), (F.col("id") % 50).alias("v"), F.col("id").alias("u"))
    got = ranked(rows, [F.desc("v"), F.asc("u")], ["g"], "test-ranks").collect()
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["g"], -r["v"], r["u"])):
        want.setdefault(r["g"], []).append(r["u"])
    assert {(r["g"], r["rank"], r["u"]) for r in got} == {(g, k + 1, u) for g, us in want.items() for k, u in enumerate(us)}
