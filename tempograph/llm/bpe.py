"""Byte-level BPE encoding and decoding.

A piece of text holds a segment tree over its adjacent pairs: a leaf has the pair's merge rank and
place, so that the root yields the leftmost pair of lowest rank. Merging it updates at most three
leaves, each in logarithmic time, until the root finds no mergeable pair.

Pieces repeat, so each Python worker keeps one encoder for all its tasks, which remembers what it has
encoded in two generations of bounded size: what is used again moves to the young one, and the old one
goes when that is full. Whole texts of any length are encoded: a long one is a sequence of pieces, and a
long piece costs n log n.
"""

from __future__ import annotations

import hashlib
import json
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_frames, per_worker, table

VOCABULARY = "byte_bpe_50k.json"
#: Pieces remembered in each of two generations.
MEMO = 500_000
LONGEST = 48
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NONE = 1 << 62


def _latin_piece() -> re.Pattern:
    """The same for texts of Latin-1 alone, with the classes spelled out, which the plain engine finds faster."""
    of = lambda c: "".join(re.escape(chr(x)) for x in range(256) if regex.match(c, chr(x)))
    letter, number, space = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


LATIN_PIECE = _latin_piece()


def pieces(text: str) -> list[str]:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return PIECE.findall(text)
    return LATIN_PIECE.findall(text)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter of each byte in the vocabulary file, by the rule of byte-level BPE: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Known(dict):
    """piece -> (decimal ids each with a comma, decoded bytes)."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.old = bpe, {}

    def __missing__(self, piece: str):
        got = self.old.get(piece)
        if got is None:
            ids = self.bpe.encode_piece(piece.encode())
            got = "".join([f"{i}," for i in ids]).encode(), self.bpe.decode_bytes(ids)
            if len(piece) > LONGEST:
                return got
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[piece] = got
        return got


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        raw = lambda token: bytes(letters[c] for c in token)
        self.token = {i: raw(t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t.encode() for t, i in self.special.items()}
        self.start = {b: vocab[c] for c, b in letters.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.merge: list[dict[int, tuple[int, int]]] = [{} for _ in range(max(vocab.values()) + 1)]
        for rank, (a, b) in enumerate(pairs):
            self.merge[vocab[a]][vocab[b]] = rank, vocab[a + b]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known = Known(self)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Merge by the segment tree."""
        ids = [self.start[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        merge, size = self.merge, 1 << (n - 1).bit_length()
        leaves = [m[0] * n + i if (m := merge[a].get(b)) else NONE for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))]
        level = leaves + [NONE] * (size - n + 1)
        levels = [level]
        while len(level) > 1:
            level = list(map(min, level[::2], level[1::2]))
            levels.append(level)
        tree = [NONE, *(x for level in reversed(levels) for x in level)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := tree[1]) != NONE:
            i = low % n
            j = after[i]
            new = ids[i] = merge[ids[i]][ids[j]][1]
            k = after[i] = after[j]
            ids[j] = -1
            changed = [(j, NONE)]
            if k < n:
                before[k] = i
                changed.append((i, m[0] * n + i if (m := merge[new].get(ids[k])) else NONE))
            else:
                changed.append((i, NONE))
            if (h := before[i]) >= 0:
                changed.append((h, m[0] * n + h if (m := merge[ids[h]].get(new)) else NONE))
            for p, value in changed:
                p += size
                if tree[p] != value:
                    tree[p] = value
                    while p > 1:
                        a, b = tree[p], tree[p ^ 1]
                        p >>= 1
                        value = a if a < b else b
                        if tree[p] == value:
                            break
                        tree[p] = value
        return [x for x in ids if x >= 0]

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text in which no special token is sought."""
        return [i for piece in pieces(text) for i in self.encode_piece(piece.encode())]

    def parts(self, text: str):
        """(part, special id or None); special tokens' strings count as these tokens."""
        if self.cut is None or not any(s in text for s in self.special):
            yield text, None
            return
        for part in self.cut.split(text):
            if part:
                yield part, self.special.get(part)

    def encode(self, text: str) -> list[int]:
        return [i for part, own in self.parts(text) for i in ([own] if own is not None else self.encode_plain(part))]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, decimal ids joined by commas, decoded bytes; by way of what is remembered."""
        got = []
        for part, own in self.parts(text):
            if own is not None:
                got.append((f"{own},".encode(), self.token[own]))
            else:
                got += map(self.known.__getitem__, pieces(part))
        ids = b"".join([x for x, _ in got])
        return ids.count(b","), ids[:-1], b"".join([x for _, x in got])


def encoder(path: str) -> Bpe:
    """The worker's encoder of a vocabulary file."""
    return per_worker(f"bpe {path}", lambda: Bpe(path))


def tokenize(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array), decoded; one row for each input row. A null text counts as empty and has no ids.

    Repeated rows repeat, null ids stay null; other columns are ignored. Empty input gives no rows.
    """
    path = path or vocabulary_path()

    def run(batches):
        bpe = encoder(path)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch["text"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "ids": ids, "decoded": [bpe.decode(x) for x in ids]}

    return in_frames(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, ids array<int>, decoded string")


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; one row for each input row.

    A null text counts as empty: no tokens, digests of the empty string. Repeated rows repeat, null ids stay
    null; other columns are ignored. Empty input gives no rows. The vocabulary file must be at ``path`` on
    every executor.
    """
    path = path or vocabulary_path()

    def digest(bpe: Bpe, text: str):
        n, ids, raw = bpe.digest(text)
        return n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest()

    def run(batches):
        bpe = encoder(path)
        for batch in batches:
            n, ids, decoded = zip(*[digest(bpe, t or "") for t in batch["text"].to_pylist()], strict=True)
            yield {"doc_id": batch["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    return in_frames(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"))
