"""Plan tests: the physical strategy each operator is meant to get."""

import contextlib
import io

from pyspark.sql import functions as F

from faretrail.operators import joins, star
from faretrail.plans import analysis
from faretrail.sources import lens, literals
from tests.conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_flagship_counts_before_join_and_broadcasts_dim(spark):
    df = analysis.vendor_trip_counts(lens.trip_lens(spark, SF_SMALL), literals.vendor_dim(spark))
    text = plan(df)
    assert "BroadcastHashJoin" in text
    assert "HashAggregate" in text and "partial_count" in text
    # the aggregate sits below the join: counts are joined, not trips
    assert text.index("BroadcastHashJoin") < text.index("partial_count")
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_lens_scan_prunes_columns(spark):
    df = analysis.vendor_trip_counts(lens.trip_lens(spark, SF_SMALL), literals.vendor_dim(spark))
    text = plan(df)
    read = [ln for ln in text.splitlines() if ln.startswith("ReadSchema: struct<l_")][0]
    assert "l_suppkey" in read and "l_quantity" not in read and "l_shipdate" not in read


def test_strategy_hints_pick_join_operator(spark):
    fact = star.fact_trips(star.key_trips(lens.trip_lens(spark, SF_SMALL), lens.NATURAL_KEY))
    vendors = literals.vendor_dim(spark)
    auto = plan(joins.join(fact, vendors, "VendorID"))
    assert "BroadcastHashJoin" in auto and "BuildRight" in auto
    assert "SortMergeJoin" in plan(joins.join(fact, vendors, "VendorID", strategy="merge"))
    assert "ShuffledHashJoin" in plan(joins.join(fact, vendors, "VendorID", strategy="shuffle_hash"))


def test_building_a_join_runs_no_job(spark):
    big = spark.range(0, 1000).withColumn("k", F.col("id") % 3)
    small = spark.range(0, 3).withColumnRenamed("id", "k")
    spark.sparkContext.setJobGroup("no-job", "no job")
    for strategy in joins.STRATEGIES:
        joins.join(big, small, "k", strategy=strategy)
    joins.salted_join(big, small, "k")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("no-job")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_salted_join_splits_a_hot_key_without_aqe(spark):
    fact = spark.range(0, 5000).select("id", F.lit(1).alias("k"))
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.salted_join(fact, dim, "k")
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in parts) == 5000 and len(parts) > 3
        assert out.columns == ["k", "id", "name"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_keying_by_position_shuffles_nothing(spark):
    from faretrail.functions import keys
    seen = []
    real = keys._staged
    keys._staged = lambda df, label: seen.append(plan(df)) or real(df, label)
    try:
        stage = keys.stage_positions(spark.range(0, 1000, 1, 7))
    finally:
        keys._staged = real
    assert "Exchange" not in seen[0]
    ids = sorted(r.trip_id for r in keys.attach_dense_id(stage).collect())
    assert ids == list(range(1, 1001))
    stage.release()
    from faretrail.session import path_exists
    assert not any(path_exists(spark, p) for p in stage.paths)


def test_date_dim_deduplicates_one_column_once(spark):
    trips = lens.trip_lens(spark, SF_SMALL)
    text = plan(star.date_dim(trips), "simple")
    # partial + final aggregate over the single datekey column, labels after
    assert text.count("HashAggregate") == 2
    agg_keys = [ln for ln in text.splitlines() if "HashAggregate(keys=" in ln]
    assert all("date_format" not in ln for ln in agg_keys)
    pre = plan(star.date_dim_prededup(trips, 44), "simple")
    assert pre.count("HashAggregate") > 2  # the pre-dedup form keeps its extra aggregations


def test_partition_pruning_on_typed_partition_columns(spark, tmp_path):
    from faretrail.sinks.files import write_partitioned
    from faretrail.sources.files import read_partitioned
    df = spark.range(1, 32).select(F.lit(2023).alias("year"), F.lit(5).alias("month"),
                                   F.col("id").cast("int").alias("date"), F.col("id").alias("v"))
    path = str(tmp_path / "hive")
    write_partitioned(df, path)
    got = read_partitioned(spark, path, "year = '2023' and month = '5'", "date >= 28")
    text = plan(got)
    assert "PartitionFilters" in text and "(date#" in text.split("PartitionFilters")[1].split("\n")[0]
    assert sorted(r.date for r in got.collect()) == [28, 29, 30, 31]  # numeric, not text, order


def test_dense_key_plan_stays_distributed(spark):
    from faretrail.functions.keys import dense_key
    df = dense_key(spark.range(0, 100), ["id"])
    text = plan(df)
    # the offsets table (one row per sort partition) is broadcast; no row-level
    # data passes through a single-partition exchange
    assert "BroadcastHashJoin" in text
    assert "SinglePartition" not in text.split("BroadcastExchange")[0]


def test_bucketed_load_joins_all_three_in_place(spark):
    from faretrail.plans import warehouse
    from faretrail.session import scratch_path, unique_name
    built = warehouse.build_star(spark, lens.trip_lens(spark, SF_SMALL), order_cols=lens.NATURAL_KEY)
    loaded = warehouse.load_star(built, "_" + unique_name("b"), scratch_path(spark, "wh"), buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force shuffle-join planning
    try:
        df = warehouse.analyse_locations_loaded(spark, loaded)
        text = plan(df, "simple")
        n = df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Bucketed: true") == 3
    assert "Exchange" not in text
    assert n == lens.trip_lens(spark, SF_SMALL).count()
