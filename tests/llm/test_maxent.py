"""Language-model scores: base by brute force, probabilities that sum to one, gradients by differences, gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tempograph.llm import maxent
from tests.llm.test_operators import SCHEMA, SF, TEXTS, low


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", low(text)), None]


def base(rows):
    counts = Counter(t for r in rows if not fold(r["doc_id"]) for t in tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    return sorted(((r["doc_id"], fold(r["doc_id"]), len(t), sum(x in counts for x in t), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t)) for r in rows for t in [tokens(r["text"])]), key=str)


def same(got, want):
    got = sorted((tuple(g)[:6] for g in got), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def test_base_and_held_out_gain(spark, real):
    got = maxent.op11_lm_scoring(spark, SF).collect()
    same(got, base(real.collect()))
    held = [g for g in got if g["held_out"]]
    assert len(held) > 10 and sum(g["score"] for g in held) > sum(g["base_score"] for g in held)
    assert all(math.isfinite(g["score"]) and g["score"] < 0 for g in got)


def test_common_and_rare_words_give_the_same(spark, real, monkeypatch):
    """However few words travel to every task, sums are the same."""
    monkeypatch.setattr(maxent, "COMMON", 300)
    same(maxent.score_texts(real, rounds=1).collect(), base(real.collect()))


def test_awkward_rows(spark):
    rows = [(k, t, "en", "s", 1, "clash", 3, "no") for k, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None, None, None, None, None)] * 3 + [(None, None, None, None, None, None, None, None), (None, "a\x1cb\u0085c a", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    same(maxent.score_texts(docs).collect(), base(docs.collect()))
    assert maxent.score_texts(docs.where("false")).count() == 0
    alone = maxent.score_texts(docs.where("doc_id IS NULL"), docs.where("false")).collect()
    assert {(g["n_known"], g["train_tokens"], g["base_score"]) for g in alone} == {(0, 0, 0.0)} and all(math.isfinite(g["score"]) for g in alone)


def model():
    rng = np.random.default_rng(5)
    m = maxent.Model(rng.integers(0, 1000, maxent.SLOTS).astype(float))
    for w in m.p.values():
        w += rng.normal(0, 0.5, w.shape).astype(np.float32)
    return m


def history(text="the cat sat on the mat and the cat ran"):
    (words, code, rows, doc), *_ = maxent.blocks([text], maxent.Codes([], 0))
    return words, code, rows, doc


def test_slots_of_any_history_sum_to_one():
    m, (_, code, rows, _) = model(), history()
    for k in range(len(code)):
        every = np.arange(maxent.SLOTS, dtype=np.int64) << 32
        assert abs((10 ** m.log10_slots(every, [np.repeat(r[k], maxent.SLOTS) for r in rows])).sum() - 1) < 1e-4


def test_gradient_by_differences():
    m, (_, code, rows, _) = model(), history()
    loss = lambda: -m.log10_slots(code, rows).sum() * math.log(10)
    total = {k: np.zeros(w.shape) for k, w in m.p.items()}
    for name, at, g, n in m.gradient(code, rows):
        total[name][at] += g
    rng = np.random.default_rng(1)
    for name, g in total.items():
        for at in np.argwhere(g)[rng.permutation(len(np.argwhere(g)))[:20]]:
            at = tuple(at)
            was, step = m.p[name][at], 1e-2
            m.p[name][at] = was + step
            up = loss()
            m.p[name][at] = was - step
            down = loss()
            m.p[name][at] = was
            assert abs((up - down) / (2 * step) - g[at]) < 2e-2


def test_features_stay_within_a_text(monkeypatch):
    """Neither the text before nor the cut of a block changes a token's history."""
    texts = ["a b c d e f", "", None, "g a b c"]
    whole = list(maxent.blocks(texts, maxent.Codes([], 0)))[0][2]
    alone = [np.concatenate(x) for x in zip(*[history(t)[2] for t in texts], strict=True)]
    assert all((x == y).all() for x, y in zip(whole, alone, strict=True))
    monkeypatch.setattr(maxent, "BLOCK", 2)
    monkeypatch.setattr(maxent, "pieces", lambda raw: [p for p in re.split(rb"(?= )", raw) if p])
    cut = [np.concatenate(x) for x in zip(*[b[2] for b in maxent.blocks(texts, maxent.Codes([], 0))], strict=True)]
    assert all((x == y).all() for x, y in zip(whole, cut, strict=True))


def test_training_learns_an_order(spark):
    """After 'red' comes 'fox': the model finds what shares of words cannot."""
    docs = spark.createDataFrame([(k, "red fox blue dog " * 50) for k in range(60)], "doc_id long, text string").repartition(3)
    got = maxent.score_texts(docs).collect()
    assert all(g["score"] > 0.5 * g["base_score"] for g in got)
