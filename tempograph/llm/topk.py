"""Exact top-k search by tiled matrix products.

Vectors are packed into tiles. Queries and candidates meet in a two-dimensional grid of shards: a
candidate tile goes to each of H query groups and a query tile to each of G shards, so that about
H * N + G * Q vectors move, with G * H near the number of tasks. For each pair of tiles, one matrix
product scores all pairs and a partial selection keeps the best k of each query; the lists are merged
as a tree: within a task for each query tile, within salted shards, and for each query.

Products that float64 holds exactly, with a tie-break on 12 bits, take one matrix product; larger ones one for each pair of limbs, summed
as integers. Only rows whose products may exceed a long are multiplied as Python integers.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_frames, table

SCALE = 1024
TILE_ROWS, QUERY_ROWS = 4096, 512
#: Products up to this size are exact in float64, together with a tie-break on 12 bits.
EXACT = 2**40
#: Products up to this size are summed as integers of 64 bits; beyond, a row is multiplied as Python integers and clamped to a long.
LONG = 2.0**62
LIMIT = 2**63 - 1
#: Query tiles of which a task holds the lists at once.
HELD = 64
PACKED = "dim int, n int, ids binary, m binary"
LISTS = "query_id long, shard int, top array<struct<score:long,neg:long>>"


def whole(v) -> np.ndarray:
    """floor(1024 x) / 1024, which float64 holds exactly where 1024 x would overflow too."""
    x = np.asarray(v, np.float64)
    with np.errstate(over="ignore"):
        y = np.floor(SCALE * x)
    return np.where(np.isfinite(y), y / SCALE, x)


def _pack(rows_per_tile: int):
    def pack(batches):
        held: dict[int, list] = {}

        def tiles(kept):
            ids, m = [], []
            for rows in kept:
                rows.sort(key=lambda r: r[0])
                ids.append(np.array([r[0] for r in rows], np.int64).tobytes())
                m.append(np.stack([r[1] for r in rows]).astype(np.float64).tobytes())
            return {"dim": [len(r[0][1]) for r in kept], "n": [len(r) for r in kept], "ids": ids, "m": m}

        for batch in batches:
            full = []
            for i, v in zip(batch["id"].to_pylist(), batch["v"].to_pylist(), strict=True):
                x = whole(v)
                rows = held.setdefault(len(x), [])
                rows.append((i, x))
                if len(rows) >= rows_per_tile:
                    full.append(held.pop(len(x)))
            if full:
                yield tiles(full)
        if held:
            yield tiles(list(held.values()))

    return pack


def _integers(m: np.ndarray) -> list[list[int]]:
    return [[int(x) * SCALE if abs(x) >= 2**53 else int(x * SCALE) for x in r] for r in m.tolist()]


def _limbs(m: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as a sum of limbs, the k-th times 2 ** (k * bits), each of less than ``bits`` bits and the number's sign."""
    out, rest, sign = [], np.abs(m), np.sign(m)
    while rest.any():
        high = np.floor(rest / 2.0**bits)
        out.append(sign * (rest - high * 2.0**bits))
        rest = high
    return out


def _long_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores as longs, clamped. Rows beyond what longs sum exactly are multiplied as Python integers."""
    dim = max(1, q.shape[1])
    with np.errstate(over="ignore"):
        top = [np.abs(m).max(1, initial=0) * SCALE for m in (q, c)]
    modest = [t * dim < LONG for t in top]
    # The larger rows go, of either side, until the largest product left is within bounds.
    order = np.sort(np.concatenate([t[k] for t, k in zip(top, modest, strict=True)]))[::-1]
    bound = next((x for x in [np.inf, *order] if max([a for a in top[0] if a < x], default=0) * max([a for a in top[1] if a < x], default=0) * dim < LONG), 0.0)
    modest = [k & (t < bound) for t, k in zip(top, modest, strict=True)]
    bits = int((52 - math.ceil(math.log2(dim))) // 2)
    out = np.zeros((len(q), len(c)), np.int64)
    parts = [_limbs(np.where(k[:, None], m, 0) * SCALE, bits) for m, k in zip((q, c), modest, strict=True)]
    for i, a in enumerate(parts[0]):
        for j, b in enumerate(parts[1]):
            with np.errstate(over="ignore"):
                out += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j)) if bits * (i + j) < 63 else 0
    big = [np.flatnonzero(~k) for k in modest]
    if len(big[0]) or len(big[1]):
        a, b = _integers(q), _integers(c)
        for i, j in {*((i, j) for i in big[0].tolist() for j in range(len(c))), *((i, j) for j in big[1].tolist() for i in range(len(q)))}:
            out[i, j] = max(-LIMIT, min(LIMIT, sum(map(int.__mul__, a[i], b[j]))))
    return out


def select_tile(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """For each query its best k of this tile as (score, -id), best first. ``ids`` ascend, so a smaller place wins a tie."""
    n = len(ids)
    if not q.shape[1] or math.prod([float(np.abs(q).max()), float(np.abs(c).max()), q.shape[1]]) < EXACT / SCALE**2:
        key = (q * SCALE) @ (c * SCALE).T * TILE_ROWS + (TILE_ROWS - 1 - np.arange(n))
        key[qid[:, None] == ids[None, :]] = -np.inf
        if n > k:
            key = np.take_along_axis(key, at := np.argpartition(key, n - k, axis=1)[:, n - k :], axis=1)
        else:
            at = np.broadcast_to(np.arange(n), key.shape)
        order = np.argsort(-key, axis=1)
        key, at = np.take_along_axis(key, order, axis=1), np.take_along_axis(at, order, axis=1)
        score = np.where(np.isfinite(key), np.floor_divide(np.where(np.isfinite(key), key, 0), TILE_ROWS), 0).astype(np.int64)
        return [[(int(s), -int(ids[j])) for s, j, x in zip(ss, jj, kk, strict=True) if x > -np.inf] for ss, jj, kk in zip(score, at, key, strict=True)]
    out = []
    for own, row in zip(qid, _long_scores(q, c), strict=True):
        at = np.flatnonzero(ids != own)
        if len(at) > k:
            at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
        at = at[np.lexsort((at, -row[at]))][:k]
        out.append([(int(row[j]), -int(ids[j])) for j in at])
    return out


def _products(k: int):
    def products(batches):
        held: dict[bytes, tuple[int, list]] = {}

        def lists(key):
            shard, tops = held.pop(key)
            return {"query_id": np.frombuffer(key, np.int64), "shard": np.full(len(tops), shard, np.int32), "top": [[{"score": s, "neg": i} for s, i in t] for t in tops]}

        for batch in batches:
            for dim, g, q_ids, q_m, c_ids, c_m in zip(*[batch[x].to_pylist() for x in ("dim", "g", "q_ids", "q_m", "ids", "m")], strict=True):
                qid, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                tops = select_tile(qid, np.frombuffer(q_m).reshape(len(qid), dim), ids, np.frombuffer(c_m).reshape(len(ids), dim), k)
                if q_ids in held:
                    tops = [sorted(a + b, reverse=True)[:k] for a, b in zip(held.pop(q_ids)[1], tops, strict=True)]
                held[q_ids] = g % 64, tops
                if len(held) > HELD:
                    yield lists(next(iter(held)))
        while held:
            yield lists(next(iter(held)))

    return products


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of floor(1024 x) for each query.

    Ties go to the smaller id. Rows whose id or vector is null, or with a null or non-finite component, take no part.
    Vectors are compared with those of the same length; a row never meets rows of its own id. Repeated
    query rows give one list (the vector that sorts last, should they differ); repeated candidates each
    take a place. Scores beyond a long are clamped. Empty input gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    fine = F.col("v").isNotNull() & F.col("id").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("q")).where(fine)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    # A grid of groups x shards cells, about one for each task, that moves few vectors; queries are packed by as many tasks as they fill.
    groups = max(1, min(round(math.sqrt(tasks * asking / max(1, n))), math.ceil(asking / QUERY_ROWS)))
    shards = max(1, math.ceil(tasks / groups))
    packers = max(1, min(tasks, math.ceil(asking / QUERY_ROWS / 4)))
    queries = rows.where("q").groupBy("id").agg(F.max("v").alias("v"))
    q = (
        in_frames(queries.repartition(packers, "id"), _pack(QUERY_ROWS), PACKED)
        .select("dim", F.col("ids").alias("q_ids"), F.col("m").alias("q_m"), F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("h"))
        .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    c = (
        in_frames(rows.select("id", "v"), _pack(TILE_ROWS), PACKED)
        .select("dim", "ids", "m", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int").alias("g"))
        .withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    # Spark's estimate of the query tiles leaves out their copies for each shard, so it would broadcast them all through the driver.
    lists = in_frames(c.join(q.hint("merge"), ["dim", "g", "h"]).select("dim", "g", "q_ids", "q_m", "ids", "m"), _products(k), LISTS, 1)
    best = lambda col: F.slice(F.sort_array(F.flatten(F.collect_list(col)), asc=False), 1, k).alias("top")
    merged = lists.groupBy("query_id", "shard").agg(best("top")).groupBy("query_id").agg(best("top"))
    return merged.select("query_id", F.posexplode("top").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), (-F.col("hit.neg")).alias("vec_id"), F.col("hit.score").alias("score")
    )


def op2_topk_search(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
SELECT query_id, rn::INTEGER AS rank, vec_id, score FROM r WHERE rn <= 10
"""
