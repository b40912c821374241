"""Landings of many headers in packed files, and what a load leaves on disk beside its tables."""

import bz2
import gzip
import os
import time
import zlib
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from faretrail import registry
from faretrail.operators import star
from faretrail.schemas import TRIP_COLUMNS
from faretrail.session import SHUFFLE_CLEANUP, scratch_path, shuffles_dropped
from faretrail.sinks import files as sink_files
from faretrail.sinks.tables import stage
from faretrail.sources import lens
from faretrail.streaming.incremental import IncrementalStarLoader


@pytest.fixture
def tables(spark, tmp_path):
    """lineitem and orders with dates of all three landings, null values and rows that come twice."""
    order = [(1, datetime(1992, 3, 1), "1-URGENT", 10.5), (2, datetime(1995, 3, 1), "2-HIGH", 7.25),
             (3, datetime(1998, 3, 1, 4, 5, 6), "5-LOW", None), (4, None, None, 1.0)]
    line = [(o, 10 * o + n, n, n, 1.5 * n, 100.0 * o + n, 0.05, None if n == 2 else 0.02, datetime(1999, n, 1)) for o in (1, 2, 3, 4) for n in (1, 2, 3)]
    line += line[:2] + [(2, None, None, 9, None, None, None, None, None)]
    spark.createDataFrame(order, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def shuffle_files(spark):
    found = set()
    for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for at, _, names in os.walk(top.getPath()):
            found |= {os.path.join(at, n) for n in names if n.startswith("shuffle_")}
    return found


def left_over(spark, before):
    """Shuffle files that are new since ``before`` and stay (they are removed in the background)."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_packed_files_are_loaded_by_their_headers(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("VendorID,trip_distance,l_orderkey\n1,2.5,1\n")
    (landing / "b.csv.gz").write_bytes(gzip.compress(b'trip_distance,l_orderkey,"odd, name",VendorID\n3.5,2,"z,1",7\n'))
    (landing / "c.csv.bz2").write_bytes(bz2.compress(b"vendorid,L_ORDERKEY\n9,3\nx,4\n"))
    (landing / "d.csv.deflate").write_bytes(zlib.compress("﻿VendorID,trip_distance,l_orderkey\n5,0.5,5\n".encode()))
    (landing / "empty.csv.gz").write_bytes(b"")
    (landing / "blank.csv.gz").write_bytes(gzip.compress(b""))
    (landing / "header.csv.gz").write_bytes(gzip.compress(b"l_orderkey,VendorID\n"))
    (landing / "other.txt.gz").write_bytes(gzip.compress(b"VendorID,l_orderkey\n8,6\n"))
    (landing / "b.csv.gz.part").write_bytes(gzip.compress(b"VendorID,l_orderkey\n8,6\n"))
    loader = IncrementalStarLoader(spark, str(landing), str(tmp_path / "wh"), order_cols=["l_orderkey"],
                                   extra_types={"l_orderkey": "long"}, by_header=True)
    loader.run_available()
    rows = loader.table("fact").select("trip_id", "VendorID", "trip_distance")
    assert sorted(map(tuple, rows.collect())) == [(1, 1, 2.5), (2, 7, 3.5), (3, 9, None), (4, None, None), (5, 5, 0.5)]
    (landing / "later.csv.gz").write_bytes(gzip.compress(b"l_orderkey,VendorID\n0,4\n"))
    loader.run_available()
    loader.run_available()
    assert sorted(r.VendorID for r in loader.table("fact").where("trip_id > 5").collect()) == [4]


def test_one_landing_of_three_headers_is_packed_and_its_staging_removed(spark, tables, monkeypatch):
    landed, staged = [], []
    csv, parquet = DataFrameWriter.csv, DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path, *a, **k: (landed.append((path, self._df.count())), csv(self, path, *a, **k))[1])
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (staged.append(path), parquet(self, path, *a, **k))[1])
    fact = registry.incremental_headers(spark, tables)
    typed = lens.trip_lens(spark, tables)
    assert [n for _, n in landed] == [8, 4, 3] and fact.count() == typed.count() == 15
    folder = landed[0][0].removeprefix("file:")
    names = [n for n in os.listdir(folder) if ".csv" in n and not n.startswith(".")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    assert len({gzip.open(f"{folder}/{n}").readline() for n in names}) == 3
    joined = [p.removeprefix("file:") for p in staged if "/landings-" in p]
    assert len(joined) == 1 and not os.path.exists(joined[0])
    assert same_rows(fact, star.fact_trips(star.key_trips(typed, order_cols=lens.NATURAL_KEY, keep=list(TRIP_COLUMNS))))


def test_a_landing_keeps_its_own_order_if_asked(spark, tmp_path):
    rows = spark.createDataFrame([("7", "1", "x")], "total_amount string, VendorID string, note string")
    for own, want in ((False, ["VendorID", "total_amount", "note"]), (True, ["total_amount", "VendorID", "note"])):
        sink_files.land_csv(rows, str(tmp_path / str(own)), compression="gzip", own_order=own)
        assert spark.read.option("header", True).csv(str(tmp_path / str(own))).columns == want


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_shuffle_files_go_with_their_query(spark, tmp_path, aqe):
    was, before = {k: spark.conf.get(k) for k in (SHUFFLE_CLEANUP, "spark.sql.adaptive.enabled")}, shuffle_files(spark)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        rows = spark.range(10_000).repartition(4, F.col("id") % 7)
        with shuffles_dropped(spark):
            rows.orderBy("id").write.parquet(str(tmp_path / "out"))
            assert not left_over(spark, before)
            with pytest.raises(RuntimeError), shuffles_dropped(spark):
                raise RuntimeError
        assert spark.conf.get(SHUFFLE_CLEANUP) == was[SHUFFLE_CLEANUP]
        assert rows.count() == 10_000 == spark.read.parquet(str(tmp_path / "out")).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was["spark.sql.adaptive.enabled"])


def test_a_load_leaves_no_shuffle_files(spark, tables):
    landing, paths = scratch_path(spark, "landing"), []
    sink_files.land_csv(stage(lens.raw_trip_lens(spark, tables), "raw", paths), landing)
    assert len(paths) == 1 and os.path.exists(paths[0].removeprefix("file:"))
    for by_header in (True, False):
        loader = IncrementalStarLoader(spark, landing, scratch_path(spark, "wh"), order_cols=lens.NATURAL_KEY,
                                       extra_types=lens.NATURAL_KEY_TYPES, by_header=by_header)
        before, was = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
        loader.run_available()
        assert not left_over(spark, before) and spark.conf.get(SHUFFLE_CLEANUP) == was
        assert loader.table("fact").count() == 15
