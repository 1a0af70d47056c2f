"""Language-model scoring by a hashed maximum-entropy model.

Words fall into ``SLOTS`` slots: one of its own for each word with a share of at least 2 / SLOTS of the training tokens (at
most SLOTS / 2 words can have that), the others by hash. A slot is a member of a class, and

    P(word | history) = P(class | history) * P(member | class, history) * P(word | slot)

The first two are softmaxes over weights of hashed features: the word before, the two words before as an n-gram, and, for the class,
the words two and three before by themselves (skips). They start as the slots' shares, so that features only add. The last is
the word's add-one share of its slot's tokens, unknown words included.

Training is by gradient updates: in each of ``ROUNDS`` rounds every task walks over its part of the training documents of that round
in steps of ``STEP`` tokens, and the tasks' changes, weighted by how often each feature was met, are averaged for the next round.
Every training document is used in one round. Scoring and training work on numpy arrays of feature numbers.

Counts of all words come from all training documents. Words of a share of 1 / COMMON or more, at most COMMON by that, go to every task; all
others meet their counts by a join, in which no key is frequent.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, in_frames, pieces, stored, table, whole_text

FOLDS, HELD = 7, 2
CLASSES = MEMBERS = 16
SLOTS, ROWS, COMMON = CLASSES * MEMBERS, 1 << 15, 1 << 20
ROUNDS, STEP, RATE = 2, 4096, 0.1
#: Tokens of a block, distinct words that a task adds up before it sends them, words whose numbers it remembers.
BLOCK, SENT, MEMO = 1 << 18, 200_000, 300_000
#: Letters in lower case, white space as spaces.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: The end of a text, which no word is.
END = b" "
#: Features of a history: the hashed words that make it up, by distance.
FEATURES = ((1,), (1, 2), (2,), (3,))
#: How many of them the members' softmax has; skips tell classes only.
NEAR = 2
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
#: Weights that travel as one row.
CHUNK = 1 << 11


def test_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 7, is 2: not learned from. A null id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS == HELD


def word_lists(text: str | None):
    """The words of a text in runs, the last of which ends with END."""
    for piece in pieces((text or "").encode().translate(PLAIN)):
        yield piece.split()
    yield [END]


def _count(batches):
    total: Counter = Counter()
    for batch in batches:
        for text in batch["text"].to_pylist():
            for words in word_lists(text):
                total.update(words)
        if len(total) >= SENT:
            yield {"word": pa.array(list(total), pa.binary()).cast(pa.string()), "n": list(total.values())}
            total.clear()
    yield {"word": pa.array(list(total), pa.binary()).cast(pa.string()), "n": list(total.values())}


class Codes(dict):
    """Of each word its crc32, its slot and, if it is common, its number from 1, in one integer. What it remembers is bounded."""

    def __init__(self, common: list[bytes], own: int):
        super().__init__()
        self.own = own
        self.fixed = {w: self.code(w, k) | k + 1 << 42 for k, w in enumerate(common)}
        self.update(self.fixed)

    def code(self, word: bytes, k: int) -> int:
        """The first ``own`` words have slots of their own."""
        crc = zlib.crc32(word)
        return crc | (k if k < self.own else self.own + crc % (SLOTS - self.own)) << 32

    def __missing__(self, word: bytes) -> int:
        crc = zlib.crc32(word)
        self[word] = code = crc | self.own + crc % (SLOTS - self.own) << 32
        return code

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self) > len(self.fixed) + MEMO:
            self.clear()
            self.update(self.fixed)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def blocks(texts: list[str | None], codes: Codes):
    """(words, codes, features, place of the text) of the tokens of texts, a block at a time."""
    words, doc, place, carry = [], [], [], np.zeros(3, np.int64)

    def close():
        code = codes.numbers(words)
        ext, at = np.concatenate([carry, code & 0xFFFFFFFF]), np.concatenate(place)
        before = {d: np.where(at >= d, ext[3 - d : len(ext) - d], 0) for d in (1, 2, 3)}
        rows = []
        for k, distances in enumerate(FEATURES):
            mixed = np.full(len(code), k + 1, np.int64)
            for d in distances:
                mixed = (mixed ^ before[d]) * MIX[k] & 0xFFFFFFFF
                mixed ^= mixed >> 15
            rows.append(mixed)
        return (list(words), code, rows, np.concatenate(doc)), ext[-3:]

    for k, text in enumerate(texts):
        at = 0
        for found in word_lists(text):
            words += found
            doc.append(np.full(len(found), k))
            place.append(np.arange(at, at + len(found)))
            at += len(found)
            if len(words) >= BLOCK:
                out, carry = close()
                yield out
                words.clear(), doc.clear(), place.clear()
    if words:
        yield close()[0]


class Model:
    """Weights of the classes and of the members within their class: (ROWS, CLASSES), (ROWS, MEMBERS), and the slots' shares."""

    def __init__(self, mass: np.ndarray):
        grid = mass.reshape(MEMBERS, CLASSES).T + 1.0  # slot = member * CLASSES + class
        self.p = {"class": np.zeros((ROWS, CLASSES), np.float32), "member": np.zeros((ROWS, MEMBERS), np.float32)}
        self.start = {"class": np.log(grid.sum(1) / grid.sum()).astype(np.float32), "member": np.log(grid / grid.sum(1, keepdims=True)).astype(np.float32)}

    def layers(self, code: np.ndarray, rows: list[np.ndarray]):
        """Of both softmaxes: its name, the rows of its weights, its logits before features, and the outcome."""
        slot = code >> 32 & 0x3FF
        cls, member = slot % CLASSES, slot // CLASSES
        yield "class", [r & ROWS - 1 for r in rows], self.start["class"][None, :], cls
        yield "member", [(r ^ (cls + 1) * 0x2545F491) * 0x9E3779B1 >> 7 & ROWS - 1 for r in rows[:NEAR]], self.start["member"][cls], member

    def probabilities(self, name: str, rows: list[np.ndarray], base: np.ndarray) -> np.ndarray:
        w = self.p[name]
        z = w.take(rows[0], axis=0)
        for r in rows[1:]:
            z += w.take(r, axis=0)
        z += base
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z

    def log10_slots(self, code: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each token's slot given its history."""
        total = np.zeros(len(code))
        for name, at, base, hit in self.layers(code, rows):
            p = self.probabilities(name, at, base)
            total += np.log10(np.maximum(p[np.arange(len(hit)), hit], 1e-30).astype(np.float64))
        return total

    def gradient(self, code: np.ndarray, rows: list[np.ndarray]):
        """Of each softmax: its name, the distinct rows of its weights, their gradient over some tokens, and how often each row occurs."""
        for name, at, base, hit in self.layers(code, rows):
            g = self.probabilities(name, at, base)
            g[np.arange(len(hit)), hit] -= 1
            every = np.concatenate(at).astype(np.uint16)
            order = np.argsort(every, kind="stable")
            every = every[order]
            ends = np.flatnonzero(np.append(every[1:] != every[:-1], True))
            # Sums of runs as differences of running sums.
            total = np.cumsum(g.take(order % len(hit), axis=0), axis=0)[ends]
            total[1:] -= total[:-1].copy()
            yield name, every[ends], total, np.diff(ends, prepend=-1)


def _train(model: Model, common: list[bytes], own: int):
    """Each task's changes of the weights, times how often their feature was met, and that number."""

    def run(batches):
        codes, mine = Codes(common, own), Model.__new__(Model)
        mine.start, mine.p = model.start, {k: w.copy() for k, w in model.p.items()}
        met = {k: np.zeros(ROWS, np.float32) for k in mine.p}
        power = {k: np.full(ROWS, 1e-2, np.float32) for k in mine.p}
        for batch in batches:
            for _, code, rows, _ in blocks(batch["text"].to_pylist(), codes):
                for s in range(0, len(code), STEP):
                    # The gradient is taken before the step, whole, so that all features see the same weights.
                    for name, at, g, n in list(mine.gradient(code[s : s + STEP], [r[s : s + STEP] for r in rows])):
                        power[name][at] += np.einsum("ij,ij->i", g, g) / (n * g.shape[1])
                        met[name][at] += n
                        g *= (RATE / np.sqrt(n * power[name][at]))[:, None]
                        mine.p[name][at] -= g
        if any(n.any() for n in met.values()):
            for name, n in met.items():
                change = (mine.p[name] - model.p[name]) * n[:, None]
                for k in range(0, ROWS, CHUNK):
                    yield {"name": [name], "at": [k], "change": [change[k : k + CHUNK].tobytes()], "met": [n[k : k + CHUNK].tobytes()]}

    return run


def _add_up(batches):
    total: dict = {}
    for batch in batches:
        for name, at, change, met in zip(*[batch[c] for c in ("name", "at", "change", "met")], strict=True):
            c, n = np.frombuffer(change.as_buffer(), np.float32), np.frombuffer(met.as_buffer(), np.float32)
            key = name.as_py(), at.as_py()
            if key in total:
                total[key][0] += c
                total[key][1] += n
            else:
                total[key] = [c.copy(), n.copy()]
    for (name, at), (c, n) in total.items():
        yield {"name": [name], "at": [at], "change": [c.tobytes()], "met": [n.tobytes()]}


def word_counts(docs: DataFrame) -> DataFrame:
    """Stored: word, n of all rows; END counts the rows. Tasks add up first."""
    return stored(in_frames(docs.select("text"), _count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Trained:
    """What scoring needs: the model, the common words with their counts, the slots' tokens and words, N, V and the table of all counts."""

    def __init__(self, docs: DataFrame, rounds: int = ROUNDS):
        self.counts = word_counts(docs)
        totals = self.counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.tokens, self.distinct = totals["n"], totals["v"]
        rows = sorted(((-r["n"], r["word"].encode()) for r in self.counts.where(F.col("n") * COMMON >= self.tokens).collect()))
        self.common, self.n = [w for _, w in rows], np.array([-n for n, _ in rows], np.int64)
        self.own = int((self.n * (SLOTS // 2) >= self.tokens).sum())
        slot = F.lit(self.own) + F.crc32(F.encode("word", "UTF-8")) % (SLOTS - self.own)
        self.slot_n, self.slot_v = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.slot_n[: self.own], self.slot_v[: self.own] = self.n[: self.own], 1
        for r in self.counts.where(F.col("n") * (SLOTS // 2) < self.tokens).groupBy(slot.alias("slot")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            self.slot_n[r["slot"]], self.slot_v[r["slot"]] = r["n"], r["v"]
        self.model = Model(self.slot_n.astype(np.float64))
        for k in range(rounds):
            # Of a text's rows some may have no id; the text deals them.
            part = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds)) == k).select("text")
            self._merge(in_frames(part, _train(self.model, self.common, self.own), "name string, at int, change binary, met binary"))

    def _merge(self, changes: DataFrame) -> None:
        """Average the tasks' changes of each row of weights; rows stream into tasks by their place, so that each holds sums only."""
        for r in in_frames(changes.repartition("name", "at"), _add_up, "name string, at int, change binary, met binary").collect():
            w = self.model.p[r["name"]]
            change, met = np.frombuffer(r["change"], np.float32).reshape(-1, w.shape[1]), np.frombuffer(r["met"], np.float32)
            w[r["at"] : r["at"] + CHUNK] += change / np.maximum(met, 1)[:, None]


def score_texts(docs: DataFrame, train: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from ``train``, which defaults to the rows outside the held-out fold. A null text counts as empty: one token, its end. A null id
    stays null and counts as an empty one for the fold. Repeated rows repeat, in counts and in the result; other columns
    are ignored. Without training rows nothing is known: N and V are 0, and the base score is 0. Empty input gives no rows. Float sums depend in their last
    digits on how rows are dealt over tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    learned = Trained(rows.where(~test_fold(F.col("doc_id"))) if train is None else train.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text")), rounds)
    model, common, own, of_common = learned.model, learned.common, learned.own, np.log10(learned.n + 1.0)
    spread, in_slot = np.log10(float(learned.tokens + learned.distinct + 1)), np.log10(learned.slot_n + learned.slot_v + 1.0)

    def run(batches):
        from pyspark import TaskContext

        codes, row = Codes(common, own), TaskContext.get().partitionId() << 33
        for batch in batches:
            size = batch.num_rows
            n, known, base, score, rare = (np.zeros(size, t) for t in (np.int64, np.int64, np.float64, np.float64, np.int64))
            unknown: list[bytes] = []
            for words, code, features, doc in blocks(batch["text"].to_pylist(), codes):
                number, slot = code >> 42, code >> 32 & 0x3FF
                is_common = number > 0
                add = np.where(is_common, np.append(0.0, of_common)[number], 0.0)
                n += np.bincount(doc, minlength=size)
                known += np.bincount(doc[is_common], minlength=size)
                base += np.bincount(doc, add - spread, size)
                each = np.concatenate([model.log10_slots(code[s : s + STEP], [f[s : s + STEP] for f in features]) for s in range(0, len(code), STEP)])
                score += np.bincount(doc, each + add - in_slot[slot], size)
                rare += np.bincount(doc[~is_common], minlength=size)
                unknown += [words[k] for k in np.flatnonzero(~is_common).tolist()]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rare)]), pa.int32()), pa.array(unknown, pa.binary()).cast(pa.string()))
            yield {"row": row + np.arange(size), "doc_id": batch["doc_id"], "held_out": batch["held_out"], "n": n, "known": known, "base": base, "model": score, "rare": lists}
            row += size

    kind = "row long, doc_id long, held_out boolean, n long, known long, base double, model double, rare array<string>"
    scored = stored(in_frames(rows.select("doc_id", test_fold(F.col("doc_id")).alias("held_out"), "text"), run, kind), "lm-scores")
    # Counts of words that aren't common: below N / COMMON each, so that no key of this join is hot.
    words = scored.select("row", F.explode("rare").alias("word"))
    met = words.join(learned.counts.where(F.col("n") * COMMON < learned.tokens).hint("shuffle_hash"), "word")
    sums = met.groupBy("row").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("gain"))
    gain = F.coalesce("gain", F.lit(0.0))
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(learned.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("model") + gain).alias("score"),
    )


def op11_lm_scoring(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"))
