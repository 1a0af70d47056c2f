"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes run over every byte of the document. Activations are max-pooled in
chunks of two adjacent blocks, each chunk overlapping the next by one block, so that the chunks cover
the whole document. The chunks' features are combined by their mean and their maximum, and a logistic
layer gives one probability.

Training takes at most ``SAMPLE`` labelled documents (chosen by a hash of their id) and all chunks of
each, the same that scoring pools; it runs in one task of an executor, on ``SPAN`` bytes at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, in_frames, table

BLOCK, WIDTH, FILTERS = 256, 6, 24
SAMPLE, BATCH, RATE, SPAN = 4000, 64, 0.02, 1 << 16
#: Epochs go on until the mean loss has fallen by less than ``STEADY`` over the last ``PATIENCE``; fewest and most of them.
LEAST_EPOCHS, MOST_EPOCHS, PATIENCE, STEADY = 12, 60, 3, 0.005
THRESHOLD = 0.3


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled documents outside the held-out fold: doc_id, text, y."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


class Network:
    """Filters (WIDTH, 256, FILTERS) with biases, and the logistic layer over mean and max features."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"w": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), "b": np.zeros(FILTERS, np.float32), "v": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32), "c": np.zeros(1, np.float32)}

    def blocks(self, raw: bytes, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each block's largest activation by filter, and if asked for its place; long texts go by in spans of whole blocks."""
        w, n = self.p["w"], len(raw)
        x, tops, at = np.frombuffer(raw + bytes(WIDTH - 1), np.uint8), [], []
        for s in range(0, n, SPAN):
            size = min(SPAN, n - s)
            z = w[0].take(x[s : s + size], axis=0)
            for k in range(1, WIDTH):
                z += w[k].take(x[s + k : s + k + size], axis=0)
            if places:
                full = np.full((-(-size // BLOCK) * BLOCK, FILTERS), -np.inf, np.float32)
                full[:size] = z
                full = full.reshape(-1, BLOCK, FILTERS)
                where = full.argmax(1)
                tops.append(np.take_along_axis(full, where[:, None], 1)[:, 0])
                at.append(where + s + np.arange(len(where))[:, None] * BLOCK)
            else:
                tops.append(np.maximum.reduceat(z, np.arange(0, size, BLOCK)))
        return np.maximum(np.concatenate(tops) + self.p["b"], 0), np.concatenate(at) if places else None

    def pooled(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes, and of each chunk the largest activation by filter and its place."""
        m, at = self.blocks(raw, places=True)
        if len(m) > 1:
            left = m[:-1] >= m[1:]
            m, at = np.where(left, m[:-1], m[1:]), np.where(left, at[:-1], at[1:])
        return np.frombuffer(raw + bytes(WIDTH - 1), np.uint8), m, at

    def step(self, raws: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        """The gradient over a batch of documents."""
        p, lines = self.p, np.arange(FILTERS)
        got = [self.pooled(raw) if raw else None for raw in raws]
        feats = np.stack([np.concatenate([g[1].mean(0), g[1].max(0)]) if g else np.zeros(2 * FILTERS, np.float32) for g in got])
        z = np.clip(feats @ p["v"] + p["c"], -30, 30)
        self.loss = float((np.logaddexp(0, z) - y * z).sum())
        g = (1 / (1 + np.exp(-z)) - y).astype(np.float32) / len(y)
        grad = {"v": feats.T @ g + 1e-4 * p["v"], "c": np.array([g.sum()])}
        each, weights = [], []
        for k, one in enumerate(got):
            if one:
                x, m, at = one
                df = g[k] * p["v"]
                top = m == feats[k, FILTERS:]  # of several chunks, if the largest lies in their common block
                dm = (df[:FILTERS] / len(m) + df[FILTERS:] * top / top.sum(0)) * (m > 0)
                row, col = np.nonzero(dm)
                each.append(x[at[row, col, None] + np.arange(WIDTH)] * np.int64(FILTERS) + np.arange(WIDTH) * (256 * FILTERS) + lines[col, None])
                weights.append(dm[row, col])
        if each:
            cells, dm = np.concatenate(each), np.concatenate(weights)
            grad["w"] = np.bincount(cells.ravel(), np.repeat(dm, WIDTH), WIDTH * 256 * FILTERS).reshape(p["w"].shape).astype(np.float32)
            grad["b"] = np.bincount(cells[:, 0] % FILTERS, dm, FILTERS).astype(np.float32)
        return grad

    def fit(self, raws: list[bytes], y: np.ndarray) -> Network:
        """By gradient steps with running means of the gradient and its square, until the loss is steady; ``losses`` keeps each epoch's mean."""
        rng, p, step = np.random.default_rng(11), self.p, 0
        mom = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in p.items()}
        self.losses = []
        while len(self.losses) < MOST_EPOCHS:
            total = 0.0
            for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
                grad = self.step([raws[d] for d in part], y[part])
                total += self.loss
                step += 1
                for k, g in grad.items():
                    m1, m2 = mom[k]
                    m1 += 0.1 * (g - m1)
                    m2 += 0.001 * (g**2 - m2)
                    p[k] -= RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            self.losses.append(total / len(y))
            if len(self.losses) >= LEAST_EPOCHS and min(self.losses[:-PATIENCE]) - min(self.losses[-PATIENCE:]) < STEADY:
                break
        return self

    def features(self, raw: bytes) -> np.ndarray:
        """Mean and max over the overlapping chunks of a whole document."""
        if not raw:
            return np.zeros(2 * FILTERS, np.float32)
        m, _ = self.blocks(raw)
        m = np.maximum(m[:-1], m[1:]) if len(m) > 1 else m
        return np.concatenate([m.mean(0), m.max(0)])

    def score(self, raw: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(raw) @ self.p["v"] + self.p["c"][0], -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network:
    """Fit on the bounded sample, in one task. Without labels the network stays as it began."""

    def fit(batches):
        rows = sorted((i, y, (t or "").encode()) for batch in batches for i, y, t in zip(*[batch[c].to_pylist() for c in ("doc_id", "y", "text")], strict=True))
        if rows:
            p = Network().fit([r[2] for r in rows], np.array([r[1] for r in rows], np.float32)).p
            yield {"name": list(p), "value": [a.tobytes() for a in p.values()]}

    net = Network()
    for r in in_frames(training_rows(docs, labels, label, SAMPLE).repartition(1), fit, "name string, value binary").collect():
        net.p[r["name"]] = np.frombuffer(r["value"], np.float32).reshape(net.p[r["name"]].shape)
    return net


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold); one row for each input row.

    Only whole texts are inputs of a score. A null text counts as empty; empty texts get the score of no
    activation. A null id stays null and counts as an empty text for the fold, which is held out. Repeated rows repeat; other columns are ignored.
    """
    net = train(docs, labels)

    def score(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": [net.score((t or "").encode()) for t in batch["text"].to_pylist()]}

    scored = in_frames(docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text"), score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns.

    Each row is judged by its own text, so repeated rows go or stay together; a null text counts as empty.
    """
    net = train(docs, labels)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array([net.score((t or "").encode()) >= threshold for t in batch["text"].to_pylist()], pa.bool_()))

    return in_frames(docs, keep, docs.schema)


def op3_quality(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
