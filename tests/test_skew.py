"""Hot groups (a third of all rows on one key) are split, never one task."""

import contextlib
import os

from pyspark.sql import functions as F

from faretrail.functions import keys
from faretrail.session import scratch_path
from faretrail.sinks.files import write_partitioned


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _hot_frame(spark, n=90_000):
    # a third of the rows share day 1; the rest spread over days 2..29
    return spark.range(0, n).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(2 + F.col("id") % 28).cast("int").alias("date"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))


def test_hot_day_is_written_by_several_tasks(spark):
    path = scratch_path(spark, "skewed-days")
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        write_partitioned(_hot_frame(spark), path)
    hot_dir = os.path.join(path.replace("file:", ""), "year=2024", "month=1", "date=1")
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1  # the hot folder was split across writer tasks
    assert spark.read.parquet(path).where("date = 1").count() == 30_000


def test_range_sort_splits_hot_leading_key(spark):
    df = _hot_frame(spark).select("date", "id")
    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        stage = keys.stage_ranked(df, ["date", "id"])
    per_part = [r["_rows"] for r in stage.offsets.collect()]
    assert sum(per_part) == 90_000
    # the 30,000 rows of the hot day are spread over several sort partitions
    assert max(per_part) < 30_000
    ids = keys.attach_dense_id(stage).agg(F.min("trip_id"), F.max("trip_id"),
                                          F.count_distinct("trip_id")).first()
    assert tuple(ids) == (1, 90_000, 90_000)
