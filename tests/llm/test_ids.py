"""Ids beyond 2**53 beside null ones, and components beyond what float64 multiplies exactly."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tempograph.llm import bpe, near_dedup, packing, topk

IDS = [(1 << 60) + 1, (1 << 60) + 3, None]


def test_large_ids_stay(spark):
    frame = spark.createDataFrame([(i, f"some text {k}") for k, i in enumerate(IDS)], "doc_id long, text string").coalesce(1)
    for f in (bpe.token_digests, packing.pack, near_dedup.near_groups):
        assert {r["doc_id"] for r in f(frame).collect()} == set(IDS)


def test_large_components():
    rng = random.Random(4)
    size = lambda: rng.choice([1.0, 1e3, 1e7, 1e12, 1e100, 1e306])
    c = np.stack([topk.whole([rng.uniform(-1, 1) * s for _ in range(4)]) for s in (size() for _ in range(60))])
    ids, qid = np.arange(60), np.arange(0, 60, 7)
    exact = lambda x: math.floor(x * 1024) if abs(x) < 1e300 else int(x) * 1024
    whole = [[int(x) * 1024 if abs(x) >= 2**53 else exact(x) for x in r] for r in c.tolist()]
    for q, got in zip(qid, topk.select_tile(qid, c[qid], ids, c, 10)):
        want = sorted(((max(-topk.LIMIT, min(topk.LIMIT, sum(a * b for a, b in zip(whole[q], whole[j])))), -j) for j in ids.tolist() if j != q), reverse=True)[:10]
        assert got == want
