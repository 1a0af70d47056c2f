"""MinHash near-deduplication by fast similarity sketching.

A sketch of t coordinates is filled in rounds: round i hashes every shingle to one bin and a value; from
round t on, round t + b puts all shingles into bin b, so that every coordinate fills. The number of equal
coordinates of two sketches concentrates around t times their Jaccard similarity.

Bands of coordinates propose candidates, and every link is verified on the two full sets of 64-bit
shingle hashes. Texts of equal sets form one class, so that copies never meet each other. In a bucket
the members are compared with its centre, the one that shares most buckets with others. Once the
components of these links are known, only buckets that still hold several components go on: their members
outside the centre's component meet all others, in tiles of bounded size, where products of 0/1 matrices
count the intersections; each pair of tiles is a row of its own, dealt by (bucket, tile). Within one
component no pair is needed, so that large groups of near copies cost a star and not a square, and what is
emitted are links, not pairs.

Buckets of more than ``CROWD`` tiles that still hold several components are crowds: texts of one template, say, that
are almost similar enough. Their members leave the buckets for smaller ones, one for each of their rarest
shingles. In one common order of shingles, rare ones first, two sets of the wanted similarity share one that
is among the first n - ceil(2 p n / (100 + p)) + 1 of the smaller set (its index) and among the first
n - ceil(p n / 100) + 1 of the larger one, so no link is lost; what texts have of their template comes late
in that order, and shingles that are in no index are dropped. These buckets go the same way, star first, where
pairs without an index member aren't needed.

A bucket, a centre or a component's root may be shared by a large part of all documents. What is told of
it is aggregated before the shuffle, and goes back to its members by (key, salt), so that no task gets all.

A pair of similarity s shares no bucket with probability (1 - s^ROWS)^BANDS, 5e-7 at 0.8.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, few, in_frames, salted_to, spread_out, stored, table

BANDS, ROWS = 48, 6
SALTS = 64
#: Members and shingles of a tile, about; columns of a matrix.
TILE, TILE_SHINGLES, COLUMNS = 256, 1 << 17, 4096
#: Tiles of an open bucket up to which its members meet tile by tile, so that each meets a bounded number of others.
CROWD = 8
#: Places by which shingles of crowds are counted to be put in order; any order is right, rare ones first is fast.
ORDER_BITS = 20
M1, M2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Ascending distinct hashes of the word shingles; with fewer words than ``width``, the whole sequence as one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    acc = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        acc = mix(acc * GOLD + h[k : k + len(acc)])
    return np.unique(acc)


def sketch(x: np.ndarray, t: int = BANDS * ROWS) -> np.ndarray:
    """Coordinates of a set that isn't empty."""
    empty = np.uint64(2**64 - 1)
    out, done = np.full(t, empty), 0
    while done < 2 * t:
        block = min(2 * t - done, max(1, round(t * (np.log(t) + 1) / len(x))) if done < t else t)
        block = min(block, t - done) if done < t else block
        i = np.arange(done, done + block, dtype=np.uint64)[:, None]
        h = mix(x[None, :] + (i + np.uint64(1)) * GOLD)
        bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if done < t else np.broadcast_to(i - np.uint64(t), h.shape)
        np.minimum.at(out, bins.ravel().astype(np.int64), ((i << np.uint64(40)) | (h & np.uint64(2**40 - 1))).ravel())
        done += block
        if not (out == empty).any():
            break
    return out


def bands(coordinates: np.ndarray) -> np.ndarray:
    c = coordinates.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * GOLD + c[:, k])
    return key.view(np.int64)


def _sketches(width: int):
    def run(batches):
        for batch in batches:
            sets = [shingles(t, width) for t in batch["text"].to_pylist()]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            yield {"doc_id": batch["doc_id"], "n_shingles": list(map(len, sets)), "digest": digests, "bands": [bands(sketch(x)) if len(x) else [] for x in sets]}

    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            yield {"id": batch["doc_id"], "set": [shingles(t, width).view(np.int64) for t in batch["text"].to_pylist()]}

    return run


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``a`` with each of ``b``, by products of 0/1 matrices over the shingles that both sides have."""
    out = np.zeros((len(a), len(b)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    values = [np.concatenate(x) for x in (a, b)]
    shared = np.intersect1d(*map(np.unique, values), assume_unique=True)
    place = [np.searchsorted(shared, v) for v in values]
    hit = [(p < len(shared)) & (shared[np.minimum(p, len(shared) - 1)] == v) if len(shared) else np.zeros(len(v), bool) for p, v in zip(place, values, strict=True)]
    kept = []
    for r, p, h in zip(rows, place, hit, strict=True):
        order = np.argsort(p[h], kind="stable")
        kept.append((r[h][order], p[h][order]))
    for low in range(0, len(shared), COLUMNS):
        m = []
        for n, (r, p) in zip((len(a), len(b)), kept, strict=True):
            own = slice(*np.searchsorted(p, [low, low + COLUMNS]))
            x = np.zeros((n, min(COLUMNS, len(shared) - low)), np.float32)
            x[r[own], p[own] - low] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


def _links(percent: int):
    """Of each pair of tiles, links between members of different components: for each member outside the main one, one link to each other component."""

    def links(m, o):
        m = [x for x in m if x["outside"]]
        if not m:
            return
        sets = [[np.frombuffer(x["set"], np.int64) for x in part] for part in (m, o)]
        both = common(*sets)
        sizes = [np.array([len(x) for x in part]) for part in sets]
        roots = [np.array([x["root"] for x in part]) for part in (m, o)]
        near = (100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)) & (roots[0][:, None] != roots[1][None, :])
        seen = set()
        for i, j in zip(*np.nonzero(near), strict=True):
            if (own := (m[i]["id"], int(roots[1][j]))) not in seen:
                seen.add(own)
                yield m[i]["id"], o[j]["id"]

    def run(batches):
        for batch in batches:
            out = []
            for same, left, right in zip(*[batch[c].to_pylist() for c in ("same", "left", "right")], strict=True):
                out += links(left, right)
                if not same:
                    out += links(right, left)
            if out:
                yield dict(zip("ab", zip(*out, strict=True), strict=True))

    return run


def _shingle_counts(width: int):
    """How often shingles fall into each of 2 ** ORDER_BITS places."""

    def run(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for t in batch["text"].to_pylist():
                total += np.bincount((shingles(t, width) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
        met = np.flatnonzero(total)
        yield {"place": met, "n": total[met]}

    return run


def _first_shingles(width: int, percent: int, counts: np.ndarray):
    """Each set's first shingles by the counts of their places, as keys, and whether they are of its index."""

    def run(batches):
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                x = shingles(text, width)
                n = len(x)
                if n:
                    x = x[np.lexsort((x, counts[(x >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]))]
                    probe, index = n + 1 + -percent * n // 100, n + 1 + -2 * percent * n // (100 + percent)
                    yield {"id": [doc_id] * probe, "n": [n] * probe, "key": x[:probe].view(np.int64), "index": np.arange(probe) < index}

    return run


def _packed_sets(width: int):
    def run(batches):
        for batch in batches:
            yield {"id": batch["doc_id"], "set": [shingles(t, width).tobytes() for t in batch["text"].to_pylist()]}

    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").join(few(ids), "doc_id", "left_semi")


def verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union, stored. Any number of pairs may share their a."""
    pairs = stored(pairs, "pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = stored(in_frames(_texts(docs, ids), _sets(width), "id long, set array<long>"), "sets")
    joined = salted_to(pairs, sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a", F.col("b"), SALTS).join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    na, nb = F.size("sa"), F.size("sb")
    near = joined.where(100 * F.least(na, nb) >= percent * F.greatest(na, nb)).withColumn("both", F.size(F.array_intersect("sa", "sb")))
    edges = stored(near.where(100 * F.col("both") >= percent * (na + nb - F.col("both"))).select("a", "b").distinct(), "edges")
    drop(pairs, ids, sets)
    return edges


def _salt(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")


MASK = "bit_or(shiftleft(1L, salt))"


def _with_lowest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with m, the smallest of u and all its neighbours."""
    marked = edges.withColumn("salt", _salt("v"))
    low = marked.groupBy("u").agg(F.min("v").alias("m"), F.expr(MASK).alias("mask")).select("u", F.least("u", "m").alias("m"), spread_out(SALTS).alias("salt"))
    return marked.join(low, ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """Roots of the components: (u, v), v the smallest id that u reaches, u > v. By alternating stars, each stored."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    state = mark(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_lowest(large).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        before, e = e, stored(small.where("u <> v").distinct(), name)
        drop(before)
        if (now := mark(e)) == state:
            break
        state = now
    return e


def _starred(placed: DataFrame, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members (id, n, index, key, salt, centre) of the buckets of (id, n, index, key) that several share, one of them by its index; and the verified links to the centres. Both stored."""
    placed = placed.withColumn("salt", _salt("id"))
    crowds = placed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("low"), F.max("id").alias("high"), F.max("index").alias("index"), F.expr(MASK).alias("mask")).where("low <> high and index")
    shared = stored(placed.join(crowds.select("key", "members", spread_out(SALTS).alias("salt")), ["key", "salt"]), "buckets")
    ranked = stored(shared.join(shared.groupBy("id").agg(F.sum("members").alias("degree")), "id"), "ranked")
    centres = ranked.groupBy("key").agg((-F.max(F.struct("degree", (-F.col("id")).alias("neg")))["neg"]).alias("centre"), F.expr(MASK).alias("mask"))
    members = stored(ranked.join(centres.select("key", "centre", spread_out(SALTS).alias("salt")), ["key", "salt"]).select("id", "n", "index", "key", "salt", "centre"), "centres")
    drop(shared, ranked)
    return members, verify(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), docs, width, percent)


def _still_open(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, but for the centres: key, id, root, outside (of the centre's component), tile, indexes, tiles, crowd. Stored.

    Tiles of members by their index come first; ``indexes`` is how many these are.
    """
    owned = members.join(stars.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left").select("id", "n", "index", "key", "salt", "centre", F.coalesce("root", "id").alias("root"))
    count = lambda x: F.greatest(F.ceil(F.count_if(x) / TILE), F.ceil(F.sum(F.when(x, F.col("n")).otherwise(0)) / TILE_SHINGLES))
    open_keys = owned.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.when(F.col("id") == F.col("centre"), F.col("root"))).alias("main"),
        count(F.col("index")).alias("indexes"), count(~F.col("index")).alias("others"), F.expr(MASK).alias("mask"),
    ).where("low <> high")
    open_keys = open_keys.select("key", "main", "indexes", "others", spread_out(SALTS).alias("salt"))
    place = F.xxhash64("id")
    tile = F.when(F.col("index"), F.pmod(place, F.col("indexes"))).otherwise(F.col("indexes") + F.pmod(place, F.col("others")))
    tiles = F.col("indexes") + F.col("others")
    return stored(owned.where("id <> centre").join(open_keys, ["key", "salt"]).select("key", "id", "root", (F.col("root") != F.col("main")).alias("outside"), tile.alias("tile"), "indexes", tiles.alias("tiles"), (tiles > CROWD).alias("crowd")), "mixed")


def _tiled(mixed: DataFrame, stars: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The stars with the links that members of open buckets have with each other, tile by tile."""
    ids = stored(mixed.select(F.col("id").alias("doc_id")).distinct(), "ids")
    sets = stored(in_frames(_texts(docs, ids), _packed_sets(width), "id long, set binary"), "packed")
    tiles = mixed.join(sets, "id").groupBy("key", "tile", "indexes", "tiles").agg(F.max("outside").alias("any"), F.collect_list(F.struct("id", "root", "outside", "set")).alias("members"))
    right = tiles.select("key", "tile", "any", F.col("members").alias("right"))
    left = tiles.where("tile < indexes").select("key", F.col("tile").alias("t"), F.col("any").alias("x"), F.col("members").alias("left"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("tile"))
    meet = left.join(right, ["key", "tile"]).where(F.col("x") | F.col("any")).select((F.col("t") == F.col("tile")).alias("same"), "left", "right")
    links = stored(in_frames(meet, _links(percent), "a long, b long", 1).distinct(), "links")
    drop(ids, sets)
    if not links.isEmpty():
        stars = components(links.union(stars.select(F.col("v").alias("a"), F.col("u").alias("b"))), "stars2")
    drop(links)
    return stars


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id, kept.

    Words are what white space parts, lower-cased in A-Z. A null text and one without words have an empty
    set and link with nothing, so they stay. Rows of one id are one document: their links add up. Rows
    without an id link with nothing and have a null component unless their set is another row's. Repeated
    rows repeat. Empty input gives no rows; other columns are ignored.
    """
    rows = stored(in_frames(docs.select(F.col("doc_id").cast("long"), "text"), _sketches(width), "doc_id long, n_shingles long, digest binary, bands array<long>"), "sketches")
    salted = rows.where("n_shingles > 0").select("doc_id", "digest", _salt("doc_id").alias("salt"))
    classes = salted.groupBy("digest", "salt").agg(F.min("doc_id").alias("rep")).groupBy("digest").agg(F.min("rep").alias("rep"), F.expr(MASK).alias("mask"))
    classes = stored(classes, "classes")

    heads = rows.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    placed = heads.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.lit(True).alias("index"), F.explode("bands").alias("key"))
    members, edges = _starred(placed, docs, width, percent)
    stars = components(edges)
    drop(edges)
    mixed = _still_open(members, stars)
    crowd = stored(mixed.where("crowd").select(F.col("id").alias("doc_id")).distinct(), "crowd")
    if not crowd.isEmpty():
        # The others of their tile; the crowds' own buckets give way to those of their rare shingles.
        small = stored(mixed.where("not crowd"), "small")
        drop(members, mixed)
        texts = _texts(docs, crowd)
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for r in in_frames(texts, _shingle_counts(width), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
            counts[r["place"]] = r["n"]
        firsts = stored(in_frames(texts, _first_shingles(width, percent, counts), "id long, n int, key long, index boolean", 64), "firsts")
        members, edges = _starred(firsts.distinct(), docs, width, percent)
        before, stars = stars, components(edges.union(stars.select(F.col("v").alias("a"), F.col("u").alias("b"))), "stars1")
        drop(before, firsts, edges)
        again = _still_open(members, stars)
        mixed = stored(small.unionByName(again), "mixed")
        drop(small, again)
    drop(members, crowd)
    if not mixed.isEmpty():
        before, stars = stars, _tiled(mixed, stars, docs, width, percent)
        if stars is not before:
            drop(before)
    drop(mixed)

    roots = classes.join(stars.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left")
    roots = roots.select("digest", F.coalesce("root", "rep").alias("component_id"), spread_out(SALTS).alias("salt"))
    own = rows.select("doc_id", "n_shingles", "digest", _salt("doc_id").alias("salt"))
    out = own.where("n_shingles > 0").join(roots, ["digest", "salt"]).select("doc_id", "n_shingles", "component_id")
    out = out.union(own.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group.

    Rows without words, or without an id, stay, unless a null id's text is a copy of another row's; rows of one id stay or go together.
    """
    gone = stored(near_groups(docs, width, percent).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(few(gone), "doc_id", "left_anti").select(docs.columns)


def op4_near_dedup(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), width=2, percent=80)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w
), x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * k >= 80 * (na + nb - k)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d),
m AS (SELECT d, min(c) AS component_id FROM r GROUP BY d)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m ON s.doc_id = m.d
"""
