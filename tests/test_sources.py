"""File-source options: name-glob narrowing and small-file bin-packing."""

from faretrail.schemas import TRIP_COLUMNS
from faretrail.sources.files import read_trips_csv, read_trips_parquet


def _csv(path, rows):
    header = ",".join(TRIP_COLUMNS)
    body = "\n".join(",".join([str(v)] + [""] * (len(TRIP_COLUMNS) - 1)) for v in rows)
    path.write_text(header + "\n" + body + "\n")


def test_time_stamped_file_names_narrowed_by_glob(spark, tmp_path):
    _csv(tmp_path / "trips-2024-5-5-0-1.csv", [1, 2])
    _csv(tmp_path / "trips-2024-5-5-0-3.csv", [2])
    _csv(tmp_path / "trips-2024-5-6-0-1.csv", [1, 1, 1])
    picked = read_trips_csv(spark, str(tmp_path), file_glob="trips-2024-5-5-0-*.csv")
    assert sorted(r.VendorID for r in picked.collect()) == ["1", "2", "2"]
    by_path = read_trips_csv(spark, str(tmp_path / "trips-2024-5-6-*.csv"))
    assert by_path.count() == 3


def test_small_files_are_bin_packed_into_few_splits(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 4000, numPartitions=40).write.parquet(path)  # 40 small files
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        packed = read_trips_parquet(spark, path).rdd.getNumPartitions()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
        fine = read_trips_parquet(spark, path).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert packed < 40 <= fine  # packed: several files per split; fine: at least one split per file
    assert read_trips_parquet(spark, path).count() == 4000
    nested = str(tmp_path / "nested")
    spark.range(0, 10).write.parquet(nested + "/a/b")
    assert read_trips_parquet(spark, nested, recursive=True).count() == 10
