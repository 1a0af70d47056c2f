"""Queries run over all rows of their tables; by brute force on small inputs."""

from tempograph.plans import catalogue


def test_array_overlap_join_takes_every_supplier(spark, tmp_path):
    rows = [(1, 10, 3), (1, 11, 20), (2, 10, 7), (2, 10, 7), (3, 12, 10), (4, 11, 9), (5, 13, 1)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    want = {(o, s) for o, p, _ in rows for _, q, s in rows if p == q}
    got = [tuple(r) for r in catalogue.QUERIES["array_overlap_join"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_left_interval_join_repeats_and_nulls(spark):
    from tempograph.operators.intervals import interval_join

    left = spark.createDataFrame([(1, 0.0, 5.0, None), (1, 0.0, 5.0, None), (2, 90.0, 95.0, "x"), (3, None, 1.0, "y")], "id int, ls double, le double, note string")
    right = spark.createDataFrame([(7, 4.0, 6.0), (8, 200.0, 201.0)], "cue int, rs double, re double")
    got = sorted((r["id"], r["cue"] or 0, r["note"] or "") for r in interval_join(left, right, 60.0, "left").collect())
    assert got == [(1, 7, ""), (1, 7, ""), (2, 0, "x"), (3, 0, "y")]
