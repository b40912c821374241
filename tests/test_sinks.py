"""Re-run tests: truncate-and-load, landing and incremental loads."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faretrail.session import scratch_path, unique_name
from faretrail.sinks import files as sink_files
from faretrail.sinks.tables import truncate_load
from faretrail.sources import lens
from faretrail.sources.files import read_trips_csv, read_trips_parquet
from faretrail.streaming.incremental import IncrementalStarLoader
from tests.conftest import SF_SMALL


def test_truncate_load_replaces_rows(spark):
    name = unique_name("t")
    loc = scratch_path(spark, "wh") + "/" + name
    first = spark.range(0, 10).withColumn("v", F.lit("a"))
    truncate_load(first, name, loc)
    assert spark.table(name).count() == 10
    second = spark.range(0, 4).select(F.lit("b").alias("v"), "id")  # other column order
    truncate_load(second, name, loc)
    rows = spark.table(name).collect()
    assert len(rows) == 4 and {r.v for r in rows} == {"b"}
    assert spark.table(name).columns == ["id", "v"]


def test_truncate_load_reading_its_own_target_stages_first(spark):
    name = unique_name("t")
    truncate_load(spark.range(0, 5), name, scratch_path(spark, "wh") + "/" + name)
    doubled = spark.table(name).select((F.col("id") * 2).alias("id"))
    truncate_load(doubled, name, stage_first=True)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 2, 4, 6, 8]


def test_csv_landing_round_trip(spark):
    raw = lens.raw_trip_lens(spark, SF_SMALL)
    path = scratch_path(spark, "csv")
    sink_files.land_csv(raw, path)
    back = read_trips_csv(spark, path, extra_types=lens.NATURAL_KEY_TYPES)
    assert back.count() == raw.count()
    assert back.select(*raw.columns).exceptAll(raw).count() == 0


def test_recursive_parquet_scan_sees_nested_files(spark):
    raw = sink_files.with_day_partitions(lens.raw_trip_lens(spark, SF_SMALL))
    path = scratch_path(spark, "nested")
    sink_files.write_partitioned(raw, path, ("year", "month"))
    assert read_trips_parquet(spark, path, recursive=True).count() == raw.count()


def test_incremental_load_reads_only_new_files(spark):
    trips = lens.trip_lens(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "inc"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    early = F.year("tpep_pickup_datetime") <= 1997
    sink_files.land_csv(lens.as_landing_text(trips.where(early)), landing)
    loader.run_available()
    n1 = loader.table("fact").count()
    assert n1 == trips.where(early).count()
    loader.run_available()  # nothing new
    assert loader.table("fact").count() == n1
    sink_files.land_csv(lens.as_landing_text(trips.where(~early)), landing)
    loader.run_available()
    fact = loader.table("fact")
    n = trips.count()
    stats = fact.agg(F.count(F.lit(1)), F.count_distinct("trip_id"), F.min("trip_id"),
                     F.max("trip_id")).first()
    assert tuple(stats) == (n, n, 1, n)
    dates = loader.table("date")
    assert dates.count() == dates.select("datekey").distinct().count()
    assert loader.table("pickup").count() == n


def test_incremental_batch_replay_is_idempotent(spark):
    trips = lens.trip_lens(spark, SF_SMALL)
    loader = IncrementalStarLoader(spark, scratch_path(spark, "landing"), scratch_path(spark, "inc"),
                                   order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    batch = lens.as_landing_text(trips)
    loader._load_batch(batch, 0)
    loader._load_batch(batch, 0)  # replay of the same epoch after a failure
    assert loader.table("fact").count() == trips.count()


def test_incremental_archives_consumed_files(spark):
    import os
    trips = lens.trip_lens(spark, SF_SMALL)
    root = scratch_path(spark, "archiving").replace("file:", "")
    landing, archive = f"{root}/landing", f"{root}/archive"
    loader = IncrementalStarLoader(spark, landing, f"{root}/wh", order_cols=lens.NATURAL_KEY,
                                   extra_types=lens.NATURAL_KEY_TYPES,
                                   clean_source="archive", archive_dir=archive)
    early = F.year("tpep_pickup_datetime") <= 1997
    sink_files.land_csv(lens.as_landing_text(trips.where(early)), landing)
    loader.run_available()
    first = {f for f in os.listdir(landing) if f.endswith(".csv")}
    sink_files.land_csv(lens.as_landing_text(trips.where(~early)), landing)
    loader.run_available()  # consumed files are moved once the next batch is planned
    assert loader.table("fact").count() == trips.count()
    left = {f for f in os.listdir(landing) if f.endswith(".csv")}
    archived = {f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")}
    assert first and first <= archived and not (first & left)


def test_stamped_landing_replaces_its_own_minute(spark, tmp_path):
    rows = spark.createDataFrame([("1", "2.5"), ("2", "3")], "VendorID string, trip_distance string")
    at = datetime(2024, 5, 5, 0, 1, 59)
    first = sink_files.land_csv_stamped(rows, str(tmp_path), at)
    assert first == str(tmp_path / "trips-2024-5-5-0-1")
    assert sink_files.land_csv_stamped(rows, str(tmp_path), at) == first  # retried: no row twice
    sink_files.land_csv_stamped(rows, str(tmp_path), datetime(2024, 5, 5, 0, 13))
    sink_files.land_csv_stamped(rows, str(tmp_path), datetime(2024, 5, 5, 10, 1))
    assert read_trips_csv(spark, str(tmp_path / "trips-2024-5-5-0-1")).count() == 2
    assert read_trips_csv(spark, str(tmp_path / "trips-2024-5-5-0-*")).count() == 4


def test_conversion_of_files_with_other_headers_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("VendorID,total_amount\n1,20.5\n")
    (tmp_path / "in" / "b.csv").write_text("total_amount,VendorID\n20.5,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        sink_files.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"))
