"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of its distinct words and
word beginnings that have weight, and 0 if it has none, so that clean text adds nothing however long it is;
the document's is their noisy-or, 1 - prod(1 - p). The weights are learned from
document labels alone, by gradient through the noisy-or over the features that stand clearly more often
in toxic documents, with an L1 step that leaves the rest without weight. The sentence scores then locate
what offends.

Training takes at most ``SAMPLE`` labelled documents (chosen by a hash of their id) and all sentences
of each that have a screened feature; it runs in one task of an executor.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, held_out, in_frames, stored, table
from .quality import training_rows

SAMPLE, MIN_DOCS, RATIO, STEPS, RATE, L1 = 8000, 4, 8.0, 250, 0.1, 1e-4
#: Lengths of the word beginnings that count as features.
STEMS = (3, 4, 5, 6)
#: Words whose features are remembered at once.
MEMO = 200_000
THRESHOLD = 0.5
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _bags(batches):
    for batch in batches:
        bags = [[" ".join(sorted(set(WORD.findall(s.lower())))) for s in SENTENCE.findall(t or "")] for t in batch["text"].to_pylist()]
        yield {"doc_id": batch["doc_id"], "y": batch["y"], "bag": bags}


class Model:
    """Weights of words and word beginnings, and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.memo = weights, bias, {}

    def known(self, word: str) -> tuple[str, ...]:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[word] = tuple(f for f in features(word) if f in self.weights)
        return got

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of the sentences with a weighted feature."""
        found, w, known = [], self.weights, self.known
        for m in SENTENCE.finditer(text):
            got = {f for x in WORD.findall(m[0].lower()) for f in known(x)}
            if got:
                found.append((m.start(), m.end(), self.bias + sum(sorted(w[x] for x in got))))
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and its offending sentences as (start, end, probability)."""
        found = self.sentences(text)
        total = sum(np.logaddexp(0, z) for *_, z in found)
        return float(-np.expm1(-total)), [(s, e, float(1 / (1 + np.exp(-z)))) for s, e, z in found if z >= 0]


def _by_feature(batches):
    for batch in batches:
        for bag, y in zip(batch["bag"].to_pylist(), batch["y"].to_pylist(), strict=True):
            found = sorted({f for s in bag for w in s.split() for f in features(w)})
            yield {"feature": found, "y": [y] * len(found)}


def _as_numbers(vocabulary: dict[str, int]):
    """Of each document: the numbers of its sentences' features, sentence by sentence."""

    def run(batches):
        for batch in batches:
            ids = [[x for s in bag if (x := sorted({vocabulary[f] for w in s.split() for f in features(w) if f in vocabulary}))] for bag in batch["bag"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "y": batch["y"], "sizes": [[len(s) for s in x] for x in ids], "ids": [[k for s in x for k in s] for x in ids]}

    return run


class Bags:
    """Documents' sentences as one array of feature numbers, with the sentence of each number and the document of each sentence."""

    def __init__(self, y, sizes, ids, features: int):
        self.y, self.features = np.asarray(y, np.float64), features
        flat = lambda x: np.concatenate([np.asarray(v, np.int64) for v in x]) if len(x) else np.zeros(0, np.int64)
        self.words, each = flat(ids), flat(sizes)
        self.doc = np.repeat(np.arange(len(self.y)), [len(x) for x in sizes])
        self.of = np.repeat(np.arange(len(self.doc)), each)
        self.weight = np.where(self.y == 1, min(5.0, (len(self.y) - self.y.sum()) / max(1, self.y.sum())), 1.0) / max(1, len(self.y))

    def step(self, w: np.ndarray, b: float) -> tuple[float, np.ndarray]:
        """The loss, and its gradient by the weights and the bias, through the noisy-or. A document without sentences has no gradient."""
        z = b + np.bincount(self.of, w[self.words], len(self.doc))
        total = np.maximum(np.bincount(self.doc, np.logaddexp(0, z), len(self.y)), 1e-9)
        loss = float((self.weight * np.where(self.y == 1, -np.log(-np.expm1(-total)), total)).sum())
        ds = self.weight * np.where(self.y == 1, -np.exp(-total) / -np.expm1(-total), 1.0)
        dz = ds[self.doc] / (1 + np.exp(-z))
        return loss, np.append(np.bincount(self.words, dz[self.of], self.features), dz.sum())


def fit(bags: Bags) -> tuple[np.ndarray, float]:
    w, b = np.zeros(bags.features), -5.0
    m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        _, g = bags.step(w, b)
        m1 += 0.1 * (g - m1)
        m2 += 0.001 * (g * g - m2)
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-6)
        w, b = w - move[:-1], b - move[-1]
        shrink = RATE * L1 / (np.sqrt(m2[:-1] / (1 - 0.999**step)) + 1e-6)
        w = np.sign(w) * np.maximum(np.abs(w) - shrink, 0)
    return w, float(b)


def _fit(vocabulary: dict[str, int]):
    def run(batches):
        rows = sorted((i, y, sizes, ids) for batch in batches for i, y, sizes, ids in zip(*[batch[c].to_pylist() for c in ("doc_id", "y", "sizes", "ids")], strict=True))
        if len({r[1] for r in rows}) == 2:
            w, b = fit(Bags([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], len(vocabulary)))
            yield {"feature": [None, *(f for f, i in vocabulary.items() if w[i])], "weight": [b, *(w[i] for i in vocabulary.values() if w[i])]}

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on the bounded sample, in one task. Without labels of both kinds no feature has weight.

    What reaches the driver are the features that pass the screen, and their weights.
    """
    sample = stored(in_frames(training_rows(docs, labels, label, SAMPLE), _bags, "doc_id long, y int, bag array<string>"), "toxic-sample")
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    odds = RATIO * n.get(1, 0) / max(1, n.get(0, 0))
    counts = in_frames(sample, _by_feature, "feature string, y int").groupBy("feature").agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
    passed = counts.where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") > odds * F.col("clean"))).select("feature").collect()
    vocabulary = {f: i for i, f in enumerate(sorted(r["feature"] for r in passed))}
    rows = in_frames(sample, _as_numbers(vocabulary), "doc_id long, y int, sizes array<int>, ids array<int>")
    got = {r["feature"]: r["weight"] for r in in_frames(rows.repartition(1), _fit(vocabulary), "feature string, weight double").collect()} if vocabulary else {}
    drop(sample)
    bias = got.pop(None, -12.0)
    return Model(got, bias)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, sentences (start, end, p of the offending ones, in code points).

    One row for each input row; only whole texts are inputs of a score. A null text counts as empty: no
    sentence, score 0. A null id stays null and counts as an empty text for the fold, which is held out. Repeated rows repeat; other
    columns are ignored.
    """
    model = train(docs, labels)

    def score(batches):
        for batch in batches:
            scores, spans = zip(*[model.score(t or "") for t in batch["text"].to_pylist()], strict=True)
            yield {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores, "sentences": [[{"start": s, "end": e, "p": p} for s, e, p in x] for x in spans]}

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = in_frames(rows, score, "doc_id long, held_out boolean, score double, sentences array<struct<start:int,end:int,p:double>>")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "sentences")


def op6_toxicity(spark, sf_dir):
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("sentences").alias("n_sentences"), F.get("sentences", F.lit(0))["start"].alias("first_start"))
