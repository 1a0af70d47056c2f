"""What the fourth round's finding asked for."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (the root of the repository is importable)
from tempograph.operators import keylists as K
from tempograph.operators import timeline as T


def shuffled(spark, df):
    """Bytes that the stages of one run of ``df`` write for shuffles."""
    stages = lambda: spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None))
    before = {s.stageId() for s in stages()}
    df.write.format("noop").mode("overwrite").save()
    return sum(s.shuffleWriteBytes() for s in stages() if s.stageId() not in before)


def test_overlap_join_shuffles_packed_lists(spark, monkeypatch):
    """Keys spread as in a large table, of which arrays took 5.1 bytes for each pair and packed lists take 2.7."""
    monkeypatch.setattr(T, "PAIRED", 1000)
    n = 30_000
    items = spark.range(n).select(*[F.pmod(F.xxhash64("id", F.lit(c)), F.lit(m)).alias(c) for c, m in (("o", 50_000_000), ("p", n // 30), ("s", 360_000))]).localCheckpoint()
    pairs = items.select("o", "p").distinct().join(items.select("s", "p").distinct(), "p").select("o", "s").distinct()
    found = T.overlap_join(items.select("o", "p"), items.select("s", "p"), "p")
    assert shuffled(spark, found) < 4 * pairs.count()
    assert found.count() == pairs.count() and not found.exceptAll(pairs).count()


def test_overlap_join_of_lists_beyond_a_batch(spark, monkeypatch):
    """An item's keys fill several batches, a key's lists several parts; extremes, nulls, repeated rows and narrow types stay."""
    monkeypatch.setattr(K, "HELD", 3000)
    b = spark.range(25_000).select((F.col("id") % 2).cast("short").alias("p"), (F.col("id") * 7 - 80_000).alias("s"))
    b = b.union(b.limit(100)).union(spark.createDataFrame([(0, -(2**63)), (0, 2**63 - 1), (1, None), (1, None), (2, None), (None, 5)], "p short, s long"))
    a = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (None, 0), (2, 2), (3, 9), (4, None), (-5, 1), (None, 2), (7, 0)], "o int, p int")
    found = T.overlap_join(a, b, "p")
    want = a.join(b, "p").select("o", "s").distinct()
    assert found.dtypes == want.dtypes and found.count() == want.count() and not found.exceptAll(want).count()
    none = T.overlap_join(a.where("false"), b, "p").count(), T.overlap_join(a, b.where("false"), "p").count()
    assert none == (0, 0)


def test_lists_keep_their_keys():
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(-(2**63), 2**63 - 1, n)) for n in range(1, 60)] + [np.array([-(2**63), -1, 0, 127, 128, 2**63 - 1])]
    keys, first = np.concatenate(lists), np.concatenate([np.arange(len(x)) == 0 for x in lists])
    packed = K.encode(keys, first)
    for i, j in ((0, 60), (7, 31)):
        got, count = K.decode(packed.slice(i, j - i))
        assert (got == np.concatenate(lists[i:j])).all() and count.tolist() == [len(x) for x in lists[i:j]]
    assert [len(x) for x in K.decode(pa.nulls(3, pa.binary()))] == [0, 3]
