"""Clip packing as a parallel prefix over piecewise maps.

What a clip needs of all clips before it is where the last one ended. As a function of that end x, the end of the next clip is

    K          where x <= T   (the clip stays at its event)
    min(M, x + C)   elsewhere (it is pushed behind the last one)

and such functions are closed under composition. So blocks of a movie's events are composed into one map each, the maps of blocks are
scanned, and each block is replayed from the end that it is entered with. Times are whole nanoseconds inside, so that a sum
doesn't depend on how blocks were cut and the result is that of one fold over the movie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from ..sources.documents import staged

SECOND = 1_000_000_000
FAR = 4_000_000_000_000_000_000
#: Events of a block, and blocks of a block of blocks.
BLOCK = 512
MAP = "struct<t:bigint,k:bigint,c:bigint,m:bigint>"


def _long(x) -> Column:
    return F.lit(x).cast("long")


def _map(t: Column, k: Column, c: Column, m: Column) -> Column:
    return F.struct(t.alias("t"), k.alias("k"), c.alias("c"), m.alias("m"))


def _apply(f: Column, x: Column) -> Column:
    return F.when(x <= f["t"], f["k"]).otherwise(F.least(f["m"], x + f["c"]))


def _then(f: Column, g: Column) -> Column:
    """g after f. Where f never passes g's threshold, the whole is constant."""
    t = F.when(f["m"] <= g["t"], _long(FAR)).otherwise(F.greatest(f["t"], g["t"] - f["c"]))
    return _map(t, _apply(g, f["k"]), f["c"] + g["c"], F.least(g["m"], f["m"] + g["c"]))


def _composed(maps: Column) -> Column:
    return F.aggregate(maps, _map(_long(-FAR), _long(-FAR), _long(0), _long(FAR)), _then)


def _entries(maps: Column, start: Column) -> Column:
    """The end that each map is entered with."""
    step = lambda acc, f: F.struct(_apply(f, acc["x"]).alias("x"), F.array_append(acc["out"], acc["x"]).alias("out"))
    return F.aggregate(maps, F.struct(start.alias("x"), F.array().cast("array<bigint>").alias("out")), step, lambda acc: acc["out"])


def pack_clips(events: DataFrame, length: float = 3.0, block: int = BLOCK) -> DataFrame:
    """movie_id, ord, start, stop, duration, pushed of clips of at most ``length`` (3 s at most) around event times.

    events: movie_id, ord, t (seconds; null: 30 for each ordinal), movie_end (the largest of a movie counts; null: 7200). A clip
    begins half a second before its event; one that would begin within a second of the last one's end is pushed to two seconds behind it.
    The end that the next clip sees isn't rounded. Events of one ordinal follow by time and repeated rows count each; a null movie is one
    movie. No events give no clips.
    """
    longest = _long(round(min(3.0, length) * SECOND))
    nano = lambda x: F.round(x * SECOND).cast("long")
    ends = events.groupBy(F.col("movie_id").alias("_m")).agg(nano(F.coalesce(F.max("movie_end"), F.lit(7200.0))).alias("end"))
    e = events.select("movie_id", "ord", nano(F.coalesce(F.col("t").cast("double"), 30.0 * F.col("ord"))).alias("at")).join(ends, F.col("movie_id").eqNullSafe(F.col("_m"))).drop("_m")
    first = F.greatest(_long(0), F.col("at") - SECOND // 2)
    e = e.select("movie_id", "ord", "at", "end", first.alias("s"), F.least(F.col("end"), first + longest).alias("e"))
    # Ranges of a movie's events, not whole movies, are what a task sorts.
    e = e.repartitionByRange("movie_id", "ord", "at").withColumn("part", F.spark_partition_id())
    own = Window.partitionBy("movie_id", "part").orderBy("ord", "at")
    e = e.withColumn("chunk", F.floor((F.row_number().over(own) - 1) / block))
    hundredth = lambda x: rounded(x / SECOND, 2)
    each = F.transform("e", lambda x: _map(x["s"] - SECOND, x["e"], nano(hundredth(x["e"] - x["s"])) + 2 * SECOND, x["end"]))
    blocks = e.groupBy("movie_id", "part", "chunk").agg(F.array_sort(F.collect_list(F.struct("ord", "at", "s", "e", "end"))).alias("e"))
    blocks = staged(blocks.withColumn("map", _composed(each)), "clip-blocks")

    # A movie's blocks, a block's worth of them at a time.
    rows = blocks.select("movie_id", "part", "chunk", "map").withColumn("group", F.floor((F.row_number().over(Window.partitionBy("movie_id").orderBy("part", "chunk")) - 1) / block))
    groups = rows.groupBy("movie_id", "group").agg(F.array_sort(F.collect_list(F.struct("part", "chunk", "map"))).alias("b"))
    groups = groups.withColumn("map", _composed(F.col("b")["map"]))
    whole = groups.groupBy("movie_id").agg(F.array_sort(F.collect_list(F.struct("group", "map", "b"))).alias("g"))
    whole = whole.select("movie_id", F.explode(F.arrays_zip(F.col("g")["b"].alias("b"), _entries(F.col("g")["map"], _long(-999 * SECOND)).alias("x"))).alias("z"))
    inner = whole.select("movie_id", F.explode(F.arrays_zip(F.col("z.b").alias("b"), _entries(F.col("z.b")["map"], F.col("z.x")).alias("x"))).alias("z"))
    entered = inner.select(F.col("movie_id").alias("_m"), F.col("z.b.part").alias("_p"), F.col("z.b.chunk").alias("_c"), F.col("z.x").alias("x"))

    def step(acc, v):
        push = acc["x"] > v["s"] - SECOND
        s = F.when(push, acc["x"] + 2 * SECOND).otherwise(v["s"])
        stop = F.when(push, F.least(v["end"], s + nano(hundredth(v["e"] - v["s"])))).otherwise(v["e"])
        clip = F.struct(v["ord"].alias("ord"), hundredth(s).alias("start"), hundredth(stop).alias("stop"), hundredth(stop - s).alias("duration"), push.alias("pushed"))
        return F.struct(stop.alias("x"), F.array_append(acc["out"], clip).alias("out"))

    kind = dict(events.dtypes)["ord"]
    out = F.array().cast(f"array<struct<ord:{kind},start:double,stop:double,duration:double,pushed:boolean>>")
    met = blocks.select("movie_id", "part", "chunk", "e").join(entered, F.col("movie_id").eqNullSafe(F.col("_m")) & (F.col("part") == F.col("_p")) & (F.col("chunk") == F.col("_c")))
    return met.select("movie_id", F.inline(F.aggregate("e", F.struct(F.col("x").alias("x"), out.alias("out")), step, lambda acc: acc["out"])))
