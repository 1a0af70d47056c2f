"""Packing by concatenate and cut.

Pass one tokenizes each partition once, writes the ids to the shared folder with each document's place
in its partition, and yields the partition's token total. A prefix sum over these totals, one small row
for each partition, gives every document its global place. Pass two cuts at the windows' borders; a
document over a border gives one record for each window it touches. Only the last sequence has padding.

The stored table fixes what lies in which partition, so a lost executor changes nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import PIECE, Bpe, vocabulary_path
from .common import in_frames, per_worker, stored, table

WINDOW, END = 1024, 0


class Ids:
    """Ids of the vocabulary file as little-endian bytes.

    Where the file's ids follow its merges, as in byte-level BPE, tiktoken yields the ids that tokenizers
    does, several times faster; else, and where tiktoken gives up, tokenizers is asked.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self.slow, self.fast = path, None, None
        bpe = Bpe(path)
        merges = sorted(m for right in bpe.merge for m in right.values())
        if merges == [(k, 256 + k) for k in range(len(merges))] and len(bpe.start) == 256:
            ranks = {t: i for i, t in bpe.token.items() if i not in bpe.special.values()}
            self.fast = tiktoken.Encoding("file", pat_str=PIECE.pattern, mergeable_ranks=ranks, special_tokens=bpe.special)

    def by_tokenizers(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.no_padding()
            self.slow.no_truncation()
        return self.slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except BaseException as error:  # beyond its limits on runs the library panics, which isn't an Exception
                if type(error).__name__ != "PanicException" and not isinstance(error, (ValueError, RuntimeError)):
                    raise
        return np.array(self.by_tokenizers(text), "<u4").tobytes()


def _tokenize(path: str):
    def run(batches):
        from pyspark import TaskContext

        ids, at, part = per_worker(f"ids {path}", lambda: Ids(path)), 0, TaskContext.get().partitionId()
        for batch in batches:
            raw = [ids(t or "") + END.to_bytes(4, "little") for t in batch["text"].to_pylist()]
            n = np.array([len(x) // 4 for x in raw], np.int64)
            yield {"doc_id": batch["doc_id"], "part": np.full(len(n), part, np.int32), "at": at + np.cumsum(n) - n, "n": n, "ids": raw}
            at += int(n.sum())

    return run


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _cut(window: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, n, ids, place in zip(*[batch[c].to_pylist() for c in ("doc_id", "n", "ids", "place")], strict=True):
                start = 0
                while start < n:
                    size = min(n - start, window - place % window)
                    out.append((doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), n, place // window, place % window))
                    start, place = start + size, place + size
            if out:
                yield dict(zip(COLUMNS, zip(*out, strict=True), strict=True))

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids end with id 0, so a null or empty text is one id. Sequences are full but the last.
    Repeated rows are packed each by itself, null ids stay null; other columns are ignored. Empty input gives no rows.
    """
    path = path or vocabulary_path()
    rows = in_frames(docs.select(F.col("doc_id").cast("long"), "text"), _tokenize(path), "doc_id long, part int, at long, n long, ids binary")
    rows = stored(rows, "pack")
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    # One row for each partition of the input: a few thousand at most, however much text there is.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), "part").select("doc_id", "n", "ids", (F.col("base") + F.col("at")).alias("place"))
    return in_frames(placed, _cut(window), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op9_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
