"""Landings that grow: bookmarked scans, other headers, days landed again, packing, ids by place."""

import hashlib
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from faretrail import registry, storage
from faretrail.functions import keys
from faretrail.operators import aggregates, joins, preview, star
from faretrail.plans import analysis
from faretrail.schemas import raw_schema
from faretrail.session import scratch_path, unique_name
from faretrail.sinks import compaction
from faretrail.sinks import files as sink_files
from faretrail.sources import lens, literals
from faretrail.sources.bookmarks import BookmarkedScan
from faretrail.sources.files import read_csv_by_header, register_partitioned_table, split_bytes
from faretrail.streaming.incremental import IncrementalStarLoader
from tests.conftest import SF_SMALL
from tests.test_plans import plan
from tests.test_skew import conf


def contents(folder):
    """relative path -> digest of every visible file."""
    out = {}
    for top, dirs, names in os.walk(folder):
        dirs[:] = [d for d in dirs if not d.startswith(("_", "."))]
        for n in names:
            if not n.startswith(("_", ".")):
                path = os.path.join(top, n)
                out[os.path.relpath(path, folder)] = hashlib.sha256(open(path, "rb").read()).hexdigest()
    return out


# ---------------------------------------------------------------- bookmarked scans

def days(spark, *numbers):
    return spark.createDataFrame([(d, f"v{d}-{k}") for d in numbers for k in range(3)], "day int, v string")


def test_bookmarks_read_new_files_alone(spark, tmp_path):
    source, seen = str(tmp_path / "hive"), []
    scan = BookmarkedScan(spark, source, str(tmp_path / "state"))
    load = lambda rows, n: seen.append((n, sorted(tuple(r) for r in rows.select("day", "v").collect()), rows.inputFiles()))
    assert scan.run(load) == 0 and seen == []  # no folder yet
    days(spark, 1, 2).repartition(1).write.partitionBy("day").parquet(source)
    assert scan.run(load) == 2 and seen[0][0] == 0 and [d for d, _ in seen[0][1]] == [1, 1, 1, 2, 2, 2]
    assert scan.run(load) == 0 and len(seen) == 1
    days(spark, 3).repartition(1).write.mode("append").partitionBy("day").parquet(source)
    assert scan.run(load) == 1 and seen[1][0] == 1
    assert [d for d, _ in seen[1][1]] == [3, 3, 3] and all("day=3" in f for f in seen[1][2])
    assert scan.consumed().count() == 3


def test_a_failed_run_is_repeated_under_its_number(spark, tmp_path):
    source, seen = str(tmp_path / "flat"), []
    scan = BookmarkedScan(spark, source, str(tmp_path / "state"))
    spark.range(4).coalesce(1).write.parquet(source)

    def fails(rows, number):
        seen.append(number)
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        scan.run(fails)
    spark.range(5).coalesce(1).write.mode("append").parquet(source)  # lands meanwhile
    assert scan.run(lambda rows, n: seen.append((n, rows.count()))) == 2
    assert seen == [0, (0, 9)]


def test_bookmarks_of_a_table_see_registered_partitions_and_predicates(spark, tmp_path):
    source = str(tmp_path / "hive")
    days(spark, 1, 2, 3).repartition(1).write.partitionBy("day").parquet(source)
    table = register_partitioned_table(spark, unique_name("marked"), source)
    days(spark, 9).repartition(1).write.mode("append").partitionBy("day").parquet(source)  # not registered
    state, seen = str(tmp_path / "state"), []
    load = lambda rows, n: seen.append(sorted({r.day for r in rows.collect()}))
    assert BookmarkedScan(spark, table, state, True, "day >= 2", "day < 3").run(load) == 1
    every = BookmarkedScan(spark, table, state, True)
    assert every.run(load) == 2 and every.run(load) == 0
    register_partitioned_table(spark, table, source)
    assert every.run(load) == 1 and seen == [[2], [1, 3], [9]]


def test_a_bounded_run_takes_the_oldest_files(spark, tmp_path):
    source, seen = str(tmp_path / "flat"), []
    for k in range(4):
        path = f"{source}/f{k}"
        spark.range(k, k + 1).coalesce(1).write.parquet(path)
        for n in os.listdir(path):
            if n.endswith(".parquet"):
                os.rename(f"{path}/{n}", f"{source}/{k}.parquet")
                os.utime(f"{source}/{k}.parquet", (1_000_000 - k, 1_000_000 - k))
    scan = BookmarkedScan(spark, f"{source}/", str(tmp_path / "state"))
    load = lambda rows, n: seen.append(sorted(r.id for r in rows.collect()))
    while scan.run(load, max_files=3):
        pass
    assert seen == [[1, 2, 3], [0]]
    os.utime(f"{source}/2.parquet", (5, 5))  # written anew
    assert scan.run(load) == 1 and seen[-1] == [2]


def test_bookmarked_loads_and_streams_don_t_share_a_warehouse(spark, tmp_path):
    rows = lens.raw_trip_lens(spark, SF_SMALL).limit(20)
    rows.write.parquet(str(tmp_path / "p"))
    first = IncrementalStarLoader(spark, str(tmp_path / "csv"), str(tmp_path / "a"), extra_types=lens.NATURAL_KEY_TYPES)
    assert first.run_bookmarked(str(tmp_path / "p")) > 0 and first.table("fact").count() == 20
    sink_files.land_csv(rows, str(tmp_path / "csv"))
    with pytest.raises(RuntimeError):
        first.run_available()
    second = IncrementalStarLoader(spark, str(tmp_path / "csv"), str(tmp_path / "b"), extra_types=lens.NATURAL_KEY_TYPES)
    second.run_available()
    with pytest.raises(RuntimeError):
        second.run_bookmarked(str(tmp_path / "p"))


# ---------------------------------------------------------------- headers

def test_files_of_many_headers(spark, tmp_path):
    texts = {"a.csv": "VendorID,trip_distance\n1,2.5\n2,x\n", "b.csv": "trip_distance,VendorID,\"odd, name\"\n3.5,7,z\n",
             "c[1].csv": "vendorid\n9\n", "d.csv": "", "e.csv": "﻿VendorID,extra\n5,0.5\n", "f.csv": "VendorID,trip_distance\n"}
    for n, t in texts.items():
        (tmp_path / n).write_text(t)
    paths = [str(tmp_path / n) for n in texts]
    schema = raw_schema({"extra": "double", "l_orderkey": "long"})
    schema = type(schema)([f for f in schema.fields if f.name in ("VendorID", "trip_distance")] + schema.fields[-2:])
    got = read_csv_by_header(spark, paths, schema)
    assert got.schema == schema
    assert sorted(map(tuple, got.collect())) == [("1", "2.5", None, None), ("2", "x", None, None), ("5", None, 0.5, None),
                                                 ("7", "3.5", None, None), ("9", None, None, None)]
    assert read_csv_by_header(spark, [str(tmp_path / "d.csv")], schema) is None
    (tmp_path / "g.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv_by_header(spark, [str(tmp_path / "g.csv")], schema)


# ---------------------------------------------------------------- days landed again

@pytest.mark.parametrize("aqe", ["true", "false"])
def test_a_day_landed_again_replaces_its_folder_alone(spark, tmp_path, aqe):
    out = str(tmp_path / "days")
    rows = spark.range(300).select((F.col("id") % 3 + 2020).cast("int").alias("year"), (F.col("id") % 2 + 1).cast("int").alias("month"),
                                   F.col("id").alias("v"))
    with conf(spark, **{"spark.sql.adaptive.enabled": aqe}):
        sink_files.write_partitioned(rows, out, ("year", "month"))
        before = contents(out)
        again = rows.where("year = 2021 AND month = 2").withColumn("v", -F.col("v"))
        sink_files.write_partitioned(again, out, ("year", "month"), mode="replace_partitions")
    after = contents(out)
    other = {k: v for k, v in before.items() if not k.startswith("year=2021/month=2/")}
    assert {k: v for k, v in after.items() if not k.startswith("year=2021/month=2/")} == other
    now = spark.read.parquet(out)
    assert now.count() == 300 and now.where("year = 2021 AND month = 2 AND v > 0").count() == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


# ---------------------------------------------------------------- packing

def test_many_small_files_become_a_few_of_the_target(spark, tmp_path):
    folder = str(tmp_path / "landing")
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    rows.repartition(500).write.parquet(folder)
    size = sum(os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.endswith(".parquet"))
    target = size // 6
    replaced, made = compaction.compact(spark, folder, target)
    names = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    assert replaced == 500 and made == len(names) and 5 <= made <= 7
    assert max(os.path.getsize(f"{folder}/{n}") for n in names) <= 1.1 * target
    now = spark.read.parquet(folder)
    assert now.dtypes == rows.dtypes and now.exceptAll(rows).count() == 0 and now.count() == 20_000
    assert not [n for n in os.listdir(folder) if n.startswith("_packing")]
    assert compaction.compact(spark, folder, target // 4) == (0, 0)  # all of them are larger


def test_folders_are_packed_by_themselves(spark, tmp_path):
    folder = str(tmp_path / "hive")
    rows = spark.range(600).select(F.concat(F.lit("a b%:+é"), F.col("id") % 3).alias("kind"), F.col("id").alias("v"))
    for _ in range(2):
        rows.repartition(8).write.mode("append").partitionBy("kind").parquet(folder)
    big = spark.range(60_000).select(F.lit("big").alias("kind"), F.xxhash64("id").alias("v"))
    big.coalesce(1).write.mode("append").partitionBy("kind").parquet(folder)
    before = contents(folder)
    assert compaction.compact(spark, folder, 400_000) == (48, 3)
    after = contents(folder)
    assert len(after) == 4 and set(after.items()) & set(before.items()) == {x for x in before.items() if x[0].startswith("kind=big")}
    now = spark.read.parquet(folder)
    assert now.where("kind <> 'big'").exceptAll(rows.unionAll(rows).select("v", "kind")).count() == 0 and now.count() == 61_200
    assert compaction.compact(spark, str(tmp_path / "none")) == (0, 0)


def test_a_stopped_packing_is_undone_or_finished(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    spark.range(1000).repartition(20).write.parquet(folder)
    before = contents(folder)
    with monkeypatch.context() as m:  # before the journal
        m.setattr(compaction.storage, "write_once", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, folder)
    assert contents(folder) == before and spark.read.parquet(folder).count() == 1000
    compaction.recover(spark, folder)
    assert contents(folder) == before and not [n for n in os.listdir(folder) if n.startswith("_packing")]
    real, moved = storage.delete, []

    def stops(s, path):
        moved.append(path)
        if len(moved) == 7:
            raise KeyboardInterrupt
        real(s, path)

    with monkeypatch.context() as m:  # in the middle of the change
        m.setattr(compaction.storage, "delete", stops)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, folder)
    compaction.recover(spark, folder)
    assert len(contents(folder)) == 1 and sorted(r.id for r in spark.read.parquet(folder).collect()) == list(range(1000))


# ---------------------------------------------------------------- ids by place, dealing, broadcasts, AQE

@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_ids_by_place_are_those_of_the_files(spark, tmp_path, fmt):
    path = str(tmp_path / "in")
    rows = spark.range(0, 9_000, 1, 3).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.write.option("header", True).option("parquet.block.size", 64 << 10).format(fmt).save(path)
    seen = []
    for size in ("16k", "100k", "128m"):
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", size)
        own.conf.set("spark.sql.files.openCostInBytes", "1k")
        frame = own.read.option("header", True).format(fmt).load(path).where("id % 7 <> 3").select("id")
        parts = frame.rdd.getNumPartitions()
        stage = keys.stage_file_positions(frame, "t")
        assert "Exchange" not in plan(stage.rows)
        got = keys.attach_dense_id(stage, "n")
        assert got.columns == ["id", "n"]
        seen.append((parts, sorted((int(r.id), r.n) for r in got.collect())))
        stage.release()
    want = [(i, k + 1) for k, i in enumerate(i for i in range(9_000) if i % 7 != 3)]
    assert all(ids == want for _, ids in seen) and seen[0][0] > seen[2][0]


def test_ids_by_place_of_a_load(spark, tmp_path):
    lens.raw_trip_lens(spark, SF_SMALL).write.parquet(str(tmp_path / "p"))
    stages = []
    trips = star.key_trips(spark.read.parquet(str(tmp_path / "p")), key="files", stages=stages)
    n = trips.count()
    assert tuple(trips.agg(F.min("trip_id"), F.max("trip_id"), F.count_distinct("trip_id")).first()) == (1, n, n)
    assert stages[0].row_count() == n and not [c for c in trips.columns if c.startswith("_")]


def test_dealing_makes_the_parts_asked_for(spark):
    rows = spark.range(1000)
    dealt = preview.dealt(rows, 7, F.col("id"))
    got = preview.partition_stats(dealt).first()
    assert tuple(got) == (7, 1000, 143) and "spark_partition_id" in plan(preview.partition_stats(dealt), "extended").lower()
    assert tuple(preview.partition_stats(preview.dealt(rows.where("id < 0"), 7, F.col("id"))).first()) == (0, None, None)


def test_the_fact_is_broadcast_within_its_bound_only(spark):
    fact = spark.range(1000).select(F.col("id").alias("trip_id"), (F.col("id") % 3).cast("int").alias("VendorID"))
    vendors = literals.vendor_dim(spark)
    small = analysis.trip_vendor(fact, vendors, "broadcast_fact", 1000)
    assert "BroadcastHashJoin" in plan(small) and "BuildLeft" in plan(small)
    for rows in (None, 10 ** 9):  # not counted, or too many
        large = analysis.trip_vendor(fact, vendors, "broadcast_fact", rows)
        assert "BuildLeft" not in plan(large) and "ShuffledHashJoin" in plan(large)
        assert sorted(large.collect()) == sorted(small.collect())
    assert joins.broadcast_bounded(fact.withColumn("name", F.lit("x")), 1) is None  # no fixed width
    assert joins.broadcast_bounded(fact, (64 << 20) // 80) is not None and joins.broadcast_bounded(fact, (64 << 20) // 80 + 1) is None


def test_joins_and_counts_are_the_same_with_and_without_aqe(spark):
    fact = star.fact_trips(star.key_trips(lens.trip_lens(spark, SF_SMALL), lens.NATURAL_KEY))
    vendors = literals.vendor_dim(spark)
    seen = []
    for aqe in ("true", "false"):
        with conf(spark, **{"spark.sql.adaptive.enabled": aqe}):
            seen.append([sorted(map(tuple, f.collect())) for f in (
                analysis.trip_vendor(fact, vendors, "merge"), analysis.trip_vendor(fact, vendors, "auto"),
                analysis.trip_vendor(fact, vendors, "broadcast_fact", 6_000),
                analysis.vendor_trip_counts(fact, vendors), aggregates.grouped_count(fact, "VendorID", "vendorid").where("vendorid IS NOT NULL"))])
    assert seen[0] == seen[1] and seen[0][0] == seen[0][1] == seen[0][2]


# ---------------------------------------------------------------- analyses kept up

def test_a_landing_adds_to_the_analyses_from_itself_alone(spark, tmp_path, monkeypatch):
    trips = lens.trip_lens(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    loader = IncrementalStarLoader(spark, landing, str(tmp_path / "wh"), order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    vendors, read = literals.vendor_dim(spark), []
    real = IncrementalStarLoader._write

    def write(self, df, name, epoch):
        if name in ("analysis", "vendor_counts"):
            read.append((epoch, [f for f in df.inputFiles() if "/wh/" in f]))
        real(self, df, name, epoch)

    monkeypatch.setattr(IncrementalStarLoader, "_write", write)
    assert loader.vendor_trip_counts(vendors) is None
    for k in range(3):
        sink_files.land_csv(lens.as_landing_text(trips.where(F.col("l_orderkey") % 3 == k)), landing)
        loader.run_available()
    assert [e for e, _ in read] == [0, 0, 1, 1, 2, 2] and not any(f for _, f in read)  # nothing loaded before is read
    full = analysis.vendor_trip_counts(loader.table("fact"), vendors)
    assert sorted(map(tuple, loader.vendor_trip_counts(vendors).collect())) == sorted(map(tuple, full.collect()))
    whole = analysis.trip_locations(loader.table("fact"), loader.table("pickup"), loader.table("dropoff"))
    assert loader.table("analysis").columns == whole.columns
    assert loader.table("analysis").exceptAll(whole).count() == 0 and whole.exceptAll(loader.table("analysis")).count() == 0
    scanned = plan(loader.vendor_trip_counts(vendors))
    assert "/vendor_counts" in scanned and "/trips" not in scanned


# ---------------------------------------------------------------- growth

def test_splits_of_a_small_reading_are_bounded(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(0, 20_000, 1, 4).write.option("header", True).csv(path)
    held = sum(os.path.getsize(f"{path}/{n}") for n in os.listdir(path) if n.endswith(".csv"))
    assert split_bytes(spark, path, ".csv", 1 << 10, 1_000) == 1 << 10
    size = split_bytes(spark, path, ".csv", 1 << 10, 10)
    assert held <= 10 * size < held + 10
    assert split_bytes(spark, str(tmp_path / "none"), ".csv", 1 << 10, 10) == 1 << 10


def test_packing_shuffles_no_row(spark, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "landing"), []
    spark.range(10_000).repartition(40).write.parquet(folder)
    real = DataFrameWriter.parquet

    def write(self, path, *args, **kwargs):
        seen.append((path, plan(self._df)))
        real(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert compaction.compact(spark, folder)[0] == 40
    files = [p for path, p in seen if "/files" in path]
    assert files and not any("Exchange" in p or "Sort" in p for p in files)
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == list(range(10_000))


def test_rows_are_finished_behind_their_shuffle(spark, tmp_path):
    rows, seen = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("k")), []

    def finish(df):
        seen.append(plan(df, "extended"))
        return df.withColumn("id", F.col("id").cast("string"))

    sink_files.write_partitioned(rows, str(tmp_path / "out"), ("k",), fmt="csv", finish=finish)
    assert "rebalance" in seen[0].lower()
    assert sorted(int(r.id) for r in spark.read.option("header", True).csv(str(tmp_path / "out")).collect()) == list(range(100))


def test_renamed_locations_join_on_one_distribution(spark):
    trips = star.key_trips(lens.trip_lens(spark, SF_SMALL), order_cols=lens.NATURAL_KEY)
    parts = star.fact_trips(trips), star.pickup_location_dim(trips), star.dropoff_location_dim(trips)
    plain = analysis.trip_locations_renamed(*parts, strategy="merge")
    one = analysis.trip_locations_renamed(*parts, strategy="merge", copied_ids=True)
    assert plan(one).count("hashpartitioning") == 3 and plan(plain).count("hashpartitioning") == 4
    assert one.columns == plain.columns and one.exceptAll(plain).count() == 0 and plain.exceptAll(one).count() == 0


def test_the_landings_of_a_query_are_joined_once(spark):
    parts = registry._landings(spark, SF_SMALL)
    assert not any("Join" in plan(p) for p in parts)
    assert sum(p.count() for p in parts) == lens.trip_lens(spark, SF_SMALL).count()
