"""Job entry points end to end: landing files -> star tables -> analysis."""

from pyspark.sql import functions as F

from faretrail.plans import jobs, warehouse
from faretrail.session import scratch_path, unique_name
from faretrail.sinks import files as sink_files
from faretrail.sources import lens
from faretrail.sources.files import register_partitioned_table
from tests.conftest import SF_SMALL


def _counts(spark, loaded):
    return {n: spark.table(t).count() for n, t in loaded.items()}


def test_csv_load_then_analyse_by_suffix(spark):
    landing = scratch_path(spark, "csv")
    sink_files.land_csv(lens.raw_trip_lens(spark, SF_SMALL), landing)
    suffix = "_" + unique_name("csv")
    loaded = jobs.load_csv(spark, landing, suffix, scratch_path(spark, "wh"))
    n = lens.trip_lens(spark, SF_SMALL).count()
    counts = _counts(spark, loaded)
    assert counts["FactTable"] == counts["PickupLocationsDim"] == counts["DropOffLocationsDim"] == n
    assert counts["VendorsDim"] == 2 and counts["PaymentTypesDim"] == 6 and counts["RateCodesDim"] == 6
    got = {r.vendorid: r["count"] for r in jobs.analyse(spark, suffix).collect()}
    want = {r.VendorID: r["count"] for r in lens.trip_lens(spark, SF_SMALL)
            .where(F.col("VendorID").isin(1, 2)).groupBy("VendorID").count().collect()}
    assert got == want
    # reload is a truncate-and-load, not an append
    jobs.load_csv(spark, landing, suffix, scratch_path(spark, "wh"))
    assert spark.table(loaded["FactTable"]).count() == n


def test_catalog_load_prunes_partitions(spark):
    landing = scratch_path(spark, "hive")
    raw = sink_files.with_day_partitions(lens.raw_trip_lens(spark, SF_SMALL))
    sink_files.write_partitioned(raw, landing)
    table = register_partitioned_table(spark, unique_name("hive"), landing)
    loaded = jobs.load_catalog(spark, table, "_" + unique_name("p"), "month = '5'", "date >= 28",
                               location_root=scratch_path(spark, "wh"))
    want = lens.trip_lens(spark, SF_SMALL).where(
        (F.month("tpep_pickup_datetime") == 5) & (F.dayofmonth("tpep_pickup_datetime") >= 28)).count()
    fact = spark.table(loaded["FactTable"])
    assert fact.count() == want and want > 0
    assert "year" not in fact.columns and fact.columns[0] == "trip_id"
    assert set(warehouse.TABLE_NAMES) == set(loaded)


def test_parquet_conversion_job(spark):
    src = scratch_path(spark, "csv")
    sink_files.land_csv(lens.raw_trip_lens(spark, SF_SMALL), src)
    dst = scratch_path(spark, "pq")
    jobs.convert_csv_to_parquet(spark, src, dst)
    back = spark.read.parquet(dst)
    assert back.count() == lens.trip_lens(spark, SF_SMALL).count()
    assert dict(back.dtypes)["fare_amount"] == "string"  # conversion keeps text


def test_bucketed_load_then_location_analysis_table(spark):
    landing = scratch_path(spark, "csv")
    sink_files.land_csv(lens.raw_trip_lens(spark, SF_SMALL), landing)
    suffix = "_" + unique_name("bk")
    jobs.load_csv(spark, landing, suffix, scratch_path(spark, "wh"),
                  order_cols=lens.NATURAL_KEY, buckets=4)
    name = unique_name("analysis_table")
    out = jobs.analyse_locations(spark, suffix, name, scratch_path(spark, "wh") + "/" + name)
    n = lens.trip_lens(spark, SF_SMALL).count()
    assert out.count() == n
    assert out.columns[:2] == ["trip_id", "vendorid"]
    # second run replaces the rows (truncate-and-load)
    jobs.analyse_locations(spark, suffix, name)
    assert spark.table(name).count() == n


def test_command_line_load_then_analyse(spark, capsys):
    landing = scratch_path(spark, "csv")
    sink_files.land_csv(lens.raw_trip_lens(spark, SF_SMALL), landing)
    suffix = "_" + unique_name("cli")
    jobs.main(["load-csv", landing, "--suffix", suffix, "--location-root",
               scratch_path(spark, "wh"), "--buckets", "4"])
    assert spark.table(f"FactTable{suffix}").count() == lens.trip_lens(spark, SF_SMALL).count()
    jobs.main(["analyse", "--suffix", suffix])
    out = capsys.readouterr().out
    assert "Creative Mobile Technologies" in out and "VeriFone Inc." in out
    table = unique_name("analysis_table")
    jobs.main(["analyse-locations", "--suffix", suffix, "--table", table,
               "--location", scratch_path(spark, "wh") + "/" + table])
    assert spark.table(table).count() == lens.trip_lens(spark, SF_SMALL).count()
