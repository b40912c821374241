"""Surrogate keys: dense ids equal a global row_number, survive hot groups."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from faretrail.functions.keys import dense_key, monotonic_key, with_landing_position


def test_dense_key_equals_global_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 37).alias("a"), (F.col("id") * 7919 % 1000).alias("b"), "id")
    keyed = dense_key(df.repartition(5), ["a", "b", "id"])
    want = df.select("id", F.row_number().over(
        Window.orderBy("a", "b", "id")).cast("long").alias("trip_id"))
    assert keyed.select("id", "trip_id").exceptAll(want).count() == 0
    assert want.exceptAll(keyed.select("id", "trip_id")).count() == 0


def test_dense_key_is_dense_with_nulls_last(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (None,), (2,)], "k int")
    rows = dense_key(df, ["k"]).orderBy("trip_id").collect()
    assert [r.trip_id for r in rows] == [1, 2, 3, 4, 5]
    assert [r.k for r in rows][:3] == [1, 2, 3]
    assert [r.k for r in rows][3:] == [None, None]


def test_dense_key_splits_hot_group_of_identical_rows(spark):
    # A third of all rows are exact copies; the landing position breaks ties,
    # so the range partitioner can still split them across tasks.
    hot = spark.range(0, 3000).select(F.lit(7).alias("v"))
    cold = spark.range(0, 6000).select(F.col("id").cast("int").alias("v"))
    df = with_landing_position(hot.union(cold))
    keyed = dense_key(df, ["v", "_landing_pos"])
    stats = keyed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("d"),
                      F.min("trip_id").alias("lo"), F.max("trip_id").alias("hi")).first()
    assert (stats.n, stats.d, stats.lo, stats.hi) == (9000, 9000, 1, 9000)


def test_dense_key_start_offset(spark):
    df = spark.range(0, 10)
    keyed = dense_key(df, ["id"], start=101)
    assert sorted(r.trip_id for r in keyed.collect()) == list(range(101, 111))


def test_monotonic_key_unique_from_one(spark):
    df = spark.range(0, 1000, numPartitions=1)
    r = monotonic_key(df).agg(F.min("trip_id"), F.count_distinct("trip_id")).first()
    assert r[0] == 1 and r[1] == 1000
