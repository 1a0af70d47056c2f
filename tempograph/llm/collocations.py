"""Phrase collocation mining by hashed bucket counts (PCY, DHP) and Apriori pruning.

The corpus is read once for each phrase length. While pass k counts phrases of k words exactly, it also
counts those of k + 1 words by hashed bucket. Before the next pass two bitmaps are broadcast, of ``BITS``
bits each whatever the corpus holds: the buckets that reach the threshold, and the buckets of the phrases
found frequent. A longer phrase is counted only if its own bucket and those of both its parts are set.
Bitmaps let some rare phrases through but stop no frequent one; the exact counts decide.

Counts are combined within blocks of text first, then by Spark's partial aggregation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, in_frames, pieces, ranked, salted_to, stored, table

MOST, LEAST, COVER, TOP = 3, 10, 50, 2000
#: Products of up to 38 digits, exact.
SCORE = "(1000000BD * CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0))) div (CAST(l AS DECIMAL(16, 0)) * CAST(r AS DECIMAL(16, 0)))"
#: Buckets of a pass, 2 ** BITS, and those that travel as one row.
BITS, SLOT = 26, 16
#: Bytes of text of one language that are counted together.
BLOCK = 8 << 20
#: Letters in lower case, tabs as spaces, what ends a piece as a byte that UTF-8 never holds.
BREAK = 0xFF
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else BREAK if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Words(dict):
    """A block's words by number; 0 is the break between pieces."""

    def __init__(self):
        super().__init__({bytes([BREAK]): 0})
        self.list = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.list)
        self.list.append(word)
        return n


def blocks(batches, carry: int):
    """(lang, words, numbers, fresh) of blocks of one language; the first ``fresh`` numbers, at most ``carry``, belong to the block before."""
    open_blocks: dict[str, list] = {}

    def close(lang):
        words, numbers, size, held = open_blocks.pop(lang)
        return lang, words.list, np.concatenate(numbers), held

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            raw = (text or "").encode().translate(PLAIN).replace(b"\xff", b" \xff ") + b" \xff "
            for piece in pieces(raw):
                words, numbers, size, held = open_blocks.get(lang) or (Words(), [], 0, 0)
                tokens = piece.split()
                numbers.append(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
                open_blocks[lang] = words, numbers, size + len(piece), held
                if size + len(piece) >= BLOCK:
                    done = close(lang)
                    yield done
                    last, words = done[2][-carry:] if carry else [], Words()
                    open_blocks[lang] = words, [np.array([words[done[1][n] or bytes([BREAK])] for n in last], np.int64)], 0, len(last)
    for lang in list(open_blocks):
        yield close(lang)


class Filter:
    """Bitmaps of phrase buckets, by phrase length."""

    def __init__(self, bits: int):
        self.bits = bits

    def bucket(self, lang: str, hashes: np.ndarray, k: int) -> np.ndarray:
        """The bucket of the phrase of ``k`` words that begins at each place; ``hashes`` are the words' own."""
        mixed = np.full(len(hashes) - k + 1, xxhash.xxh64_intdigest(lang.encode(), k), np.uint64)
        for j in range(k):
            mixed = (mixed ^ hashes[j : len(hashes) - k + 1 + j]) * PRIMES[j % len(PRIMES)]
            mixed ^= mixed >> np.uint64(29)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def words(self, words: list[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def has(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return bitmap[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1 == 1


def _sparse(bucket: np.ndarray, counts: np.ndarray, least: int):
    """Rows (slot, places, counts) of sorted buckets; counts beyond the threshold need not be told apart."""
    slot = bucket >> SLOT
    ends = [*np.flatnonzero(np.diff(slot)) + 1, len(slot)] if len(slot) else []
    start, out = 0, {"slot": [], "places": [], "counts": []}
    small, places = np.minimum(counts, least).astype(np.uint8), (bucket & ((1 << SLOT) - 1)).astype(np.uint16)
    for end in ends:
        out["slot"].append(int(slot[start]))
        out["places"].append(places[start:end].tobytes())
        out["counts"].append(small[start:end].tobytes())
        start = end
    return out


def _pass(k: int, least: int, more: bool, net: Filter, known):
    """Exact counts of phrases of ``k`` words that the bitmaps let through, and bucket counts of those of ``k + 1``."""

    def run(batches):
        parts, own = known.value if known else (None, None)
        for lang, words, numbers, held in blocks(batches, k if more else k - 1):
            hashes = net.words(words)[numbers]
            ok = numbers > 0
            if known:  # the shorter phrases that may be frequent
                short = np.ones(max(0, len(numbers) - k + 2), bool)
                for j in range(k - 1):
                    short &= ok[j : len(ok) - k + 2 + j]
                short &= has(parts, net.bucket(lang, hashes, k - 1)) if len(short) else short
                ok = short[:-1] & short[1:]
                ok = ok & has(own, net.bucket(lang, hashes, k)) if len(ok) else ok
            # A phrase counts where it ends: not if that lies in what the block before has counted.
            at = np.flatnonzero(ok)
            at_new = at[at + k > held]
            if len(at_new):
                grams = np.stack([numbers[at_new + j] for j in range(k)], 1) if k > 1 else numbers[at_new, None]
                distinct, n = _counted(grams, len(words))
                names = pa.array(words, pa.binary()).cast(pa.string())
                phrase = names.take(distinct[:, 0])
                for j in range(1, k):
                    phrase = pc.binary_join_element_wise(phrase, names.take(distinct[:, j]), " ")
                for s in range(0, len(n), 1 << 16):
                    part = phrase[s : s + (1 << 16)]
                    yield {"lang": [lang] * len(part), "phrase": part, "n": n[s : s + (1 << 16)], "slot": pa.nulls(len(part), pa.int32()), "places": pa.nulls(len(part), pa.binary()), "counts": pa.nulls(len(part), pa.binary())}
            if more and len(ok) > 1:
                longer = np.flatnonzero(ok[:-1] & ok[1:])
                longer = longer[longer + k + 1 > held]
                bucket, n = np.unique(net.bucket(lang, hashes, k + 1)[longer], return_counts=True)
                rows = _sparse(bucket, n, least)
                empty = len(rows["slot"])
                yield {"lang": pa.nulls(empty, pa.string()), "phrase": pa.nulls(empty, pa.string()), "n": pa.nulls(empty, pa.int64())} | rows

    return run


def _counted(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``grams`` (numbers below ``size``) and how often each stands there."""
    key, bound = grams[:, 0], size
    parts = []
    for j in range(1, grams.shape[1]):
        if bound * size >= 1 << 63:  # number what there is afresh, so that the key stays within 63 bits
            seen, key = np.unique(key, return_inverse=True)
            parts.append((seen, size))
            bound = len(seen)
        key, bound = key * size + grams[:, j], bound * size
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return grams[first], n


def bitmap(rows: DataFrame, least: int, bits: int) -> np.ndarray:
    """The buckets whose counts reach ``least``, as 2 ** bits bits on the driver.

    Rows are added up slot by slot as they stream by; a task holds its slots only.
    """
    full = 1 << SLOT

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, places, counts in zip(batch["slot"].to_pylist(), batch["places"], batch["counts"], strict=True):
                here = total.setdefault(slot, np.zeros(full, np.uint8))
                at = np.frombuffer(places.as_buffer(), np.uint16)
                here[at] = np.minimum(here[at] + np.frombuffer(counts.as_buffer(), np.uint8), least)
        for slot, here in total.items():
            yield {"slot": [slot], "bits": [np.packbits(here >= least, bitorder="little").tobytes()]}

    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in in_frames(rows.where("slot IS NOT NULL").select("slot", "places", "counts").repartition("slot"), run, "slot int, bits binary").collect():
        out[r["slot"] * (full >> 3) : (r["slot"] + 1) * (full >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


def _phrase_buckets(k: int, least: int, net: Filter):
    def run(batches):
        for batch in batches:
            found = []
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True):
                found.append((lang, phrase.encode().split(b" ")))
            each = [net.bucket(lang, net.words(words), k)[0] for lang, words in found]
            bucket = np.unique(np.array(each, np.int64))
            yield _sparse(bucket, np.full(len(bucket), least), least)

    return run


def frequent_phrases(docs: DataFrame, most: int = MOST, least: int = LEAST, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Stored tables (lang, phrase, n) of the phrases of 1, 2, ... ``most`` words that occur ``least`` times or more in their language, and each language's number of words."""
    spark, net = docs.sparkSession, Filter(bits)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    found, sizes, known = [], None, None
    for k in range(1, most + 1):
        rows = stored(in_frames(texts, _pass(k, least, k < most, net, known), "lang string, phrase string, n long, slot int, places binary, counts binary"), f"phrases-{k}")
        counts = rows.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if k == 1:
            sizes = stored(rows.where("phrase IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("total")), "language-sizes")
        found.append(stored(counts.where(F.col("n") >= least), f"frequent-{k}"))
        if k < most:
            own = bitmap(rows, least, bits)
            parts = bitmap(in_frames(found[-1], _phrase_buckets(k, least, net), "slot int, places binary, counts binary", 10_000), least, bits)
            if known:
                known.unpersist()
            known = spark.sparkContext.broadcast((parts, own))
        drop(rows)
    return found, sizes


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, cover: int = COVER, top: int = TOP, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of 2 to ``most`` words.

    A null text has no words, a null lang is ``und``; languages without candidates have no rows, so empty input gives none. Repeated rows
    count each time; ties end at the phrase, which a language has once. Other columns are ignored. Products are decimals of
    38 digits, exact up to 10 ** 16 occurrences.
    """
    found, sizes = frequent_phrases(docs, most, least, bits)
    counted = found[0]
    for one in found[1:-1]:
        counted = counted.unionByName(one)
    candidates = found[1]
    for one in found[2:]:
        candidates = candidates.unionByName(one)
    words = candidates.withColumn("w", F.split("phrase", " "))

    # Phrases inside longer ones that are about as frequent go.
    inside = words.where(F.size("w") > 2).select("lang", "n", F.explode(F.expr("flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))")).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = words.join(longest, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("n"), F.lit(True)))

    # Each cut's two parts find their counts; the counts' side has a part once, the cuts' side is salted.
    cuts = left.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.expr("transform(sequence(1, size(w) - 1), k -> struct(k, array_join(slice(w, 1, k), ' ') AS l, array_join(slice(w, k + 1, size(w)), ' ') AS r))")).alias("c"))
    sides = cuts.select("lang", "phrase", "a", F.col("c.k").alias("k"), F.explode(F.expr("array(struct(true AS first, named_struct('lang', lang, 'phrase', c.l) AS part), struct(false AS first, named_struct('lang', lang, 'phrase', c.r) AS part))")).alias("s"))
    sides = sides.select("lang", "phrase", "a", "k", F.col("s.first").alias("first"), F.col("s.part").alias("part"))
    parts = counted.select(F.struct("lang", "phrase").alias("part"), F.col("n").alias("m"))
    met = salted_to(sides, parts, "part", F.concat_ws(" ", "phrase"))
    both = met.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("m"))).alias("l"), F.max(F.when(~F.col("first"), F.col("m"))).alias("r"))
    lowest = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr(SCORE).alias("score"), "k", "l", "r")).alias("b"))
    flat = lowest.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    first = ranked(flat, [F.desc("score"), F.desc("a"), F.asc("phrase")], ["lang"], "collocations").where(F.col("rank") <= top)
    drop(*found)
    # A language is a row here: the counts of its words.
    return first.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL
), c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS m FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
), cut AS (
  SELECT c.lang, c.phrase, a, j, array_to_string(w[1 : j], ' ') AS lp, array_to_string(w[j + 1 : k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c LEFT JOIN longer USING (lang, phrase) WHERE m IS NULL OR 100 * m < 50 * a
), s AS (
  SELECT cut.lang, cut.phrase, a, j, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), t AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b
)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(n) FROM f WHERE k = 1 AND f.lang = t.lang)::BIGINT AS n, score FROM t WHERE rank <= 2000
"""
