"""Crowds of texts that are almost similar enough: links by their rare shingles equal brute force."""

import random

import numpy as np
import pytest

from tempograph.llm import near_dedup


def brute(texts, width, percent):
    sets = [set(near_dedup.shingles(t, width).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_template_with_few_words_of_its_own(spark, monkeypatch, seed):
    """Texts of one template, with own words at its end, or words of a few groups, of different lengths; some are near copies of others."""
    monkeypatch.setattr(near_dedup, "TILE", 8)
    monkeypatch.setattr(near_dedup, "CROWD", 1)
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(100)]
    texts = []
    for i in range(160):
        own = [f"o{i}x{k}" for k in range(rng.randint(10, 16))]
        if i % 5 == 0:
            own[: rng.randint(4, 12)] = [f"g{i % 3}x{k}" for k in range(9)]
        texts.append(" ".join(base[: rng.randint(92, 100)] + own))
        if i % 7 == 0:
            words = rng.choice(texts).split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(frame, 2).collect()}
    want = brute(texts, 2, 80)
    assert [got[i] for i in range(len(texts))] == want and 20 < len(set(want)) < len(texts)


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_first_shingles_lose_no_pair(percent):
    """Two similar sets share one that is among the probe of the larger and the index of the smaller one."""
    rng = np.random.default_rng(percent)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.permutation(words[: rng.integers(20, 60)])) if k % 3 == 0 else None for k in range(60)]
    for k in range(60):
        if texts[k] is None:
            w = texts[k - k % 3].split()
            texts[k] = " ".join(w[: len(w) - int(rng.integers(0, 6))])
    batch = {"doc_id": list(range(60)), "text": texts}

    class Column(list):
        def to_pylist(self):
            return list(self)

    counts = rng.integers(0, 5, 1 << near_dedup.ORDER_BITS)
    rows = {}
    for out in near_dedup._first_shingles(2, percent, counts)([{k: Column(v) for k, v in batch.items()}]):
        rows[out["id"][0]] = (out["n"][0], set(out["key"].tolist()), set(out["key"][out["index"]].tolist()))
    sets = [set(near_dedup.shingles(t, 2).tolist()) for t in texts]
    found = 0
    for i in range(60):
        for j in range(60):
            if i != j and len(sets[i]) >= len(sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                found += 1
                assert rows[i][1] & rows[j][2]
    assert found > 20
