"""Sentences of sampled documents, the noisy-or by hand, its gradient by differences, and clean text of any length."""

import math

import numpy as np
import pyarrow as pa

from tempograph.llm import toxicity


def test_training_takes_every_sentence():
    text = " ".join("an awful one." if k == 1001 else f"plain word {k}." for k in range(1500))
    bag = next(toxicity._bags([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text], "y": [1]})]))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "y": [1], "bag": bag["bag"]})
    got = next(toxicity._as_numbers({"awful": 0, "one": 1})([rows]))
    assert got["sizes"][0] == [2] and got["ids"][0] == [0, 1]


def slow(model, text):
    """Each sentence by itself: the set of its words and their beginnings."""
    miss, spans, at = 1.0, [], 0
    for s in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        words = "".join(c if c.isalpha() else " " for c in s.lower()).split()
        z = sum(model.weights.get(f, 0.0) for f in {f for w in words for f in [w, *(w[:n] + "*" for n in (3, 4, 5, 6) if len(w) > n)]})
        if any(f in model.weights for w in words for f in [w, *(w[:n] + "*" for n in (3, 4, 5, 6) if len(w) > n)]):
            p = 1 / (1 + math.exp(-model.bias - z))
            miss *= 1 - p
            if model.bias + z >= 0:
                spans.append((at, at + len(s), p))
        at += len(s) + 1
    return 1 - miss, spans


def test_noisy_or_and_located_sentences():
    model = toxicity.Model({"vile": 4.0, "awf*": 2.5, "good": -3.0, "horrib*": 1.0}, -3.0)
    for text in ("", "Nothing here.", "So vile! A good day, vile? good", "awful awfully AWFUL.x\nawf horribly vile", "... vile", "çvile vile-good 3vile3"):
        score, spans = model.score(text)
        want, places = slow(model, text)
        assert np.isclose(score, want) and [(s, e) for s, e, _ in spans] == [(s, e) for s, e, _ in places]
        assert np.allclose([p for *_, p in spans], [p for *_, p in places])


def test_gradient_by_differences():
    rng = np.random.default_rng(3)
    sizes = [[2, 1], [], [3], [1, 1, 1], [2]]
    bags = toxicity.Bags([1, 0, 1, 0, 1], sizes, [rng.integers(0, 6, sum(x)).tolist() for x in sizes], 6)
    w, b = rng.normal(0, 1, 6), -1.0
    grad = bags.step(w, b)[1]
    for k in range(7):
        d = np.zeros(7)
        d[k] = 1e-6
        up, down = (bags.step(w + s * d[:6], b + s * d[6])[0] for s in (1, -1))
        assert np.isclose((up - down) / 2e-6, grad[k], atol=1e-6)


def test_clean_text_adds_nothing():
    model = toxicity.Model({"vile": 4.0}, -2.0)
    assert model.score("plain words. " * 100_000)[0] == 0 and model.score("a vile one. " + "plain words. " * 1000)[0] == model.score("a vile one.")[0]


def test_toxic_word_is_found(spark):
    rows = [(k, ("A calm day. " * (k % 9) + ("What a vile fool. " if k % 4 == 0 else "") + "Then rain. " * (k % 5))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got)
    for r in got:
        text = dict(rows)[r["doc_id"]]
        assert [text[s["start"] : s["end"]].strip() for s in r["sentences"]] == (["What a vile fool"] if r["doc_id"] % 4 == 0 else [])
    one_kind = toxicity.score_toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in one_kind} == {0.0}
