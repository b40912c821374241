"""What rankings and landings write: no copy before a ranking, packed landings, ids made behind the shuffle."""

import os
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from faretrail import registry
from faretrail.functions.keys import stage_ranked
from faretrail.operators import star
from faretrail.plans import warehouse
from faretrail.schemas import TRIP_COLUMNS, raw_schema
from faretrail.session import scratch_path, unique_name
from faretrail.sinks import files as sink_files
from faretrail.sinks.tables import truncate_load
from faretrail.sources import lens
from faretrail.streaming.incremental import IncrementalStarLoader
from tests.conftest import SF_SMALL
from tests.test_plans import plan


@pytest.fixture
def written(monkeypatch):
    """(path, columns) of every Parquet folder that is written."""
    seen = []
    real = DataFrameWriter.parquet

    def write(self, path, *args, **kwargs):
        seen.append((path, self._df.columns))
        real(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    return seen


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_typed_trips_are_ranked_without_a_copy(spark, written):
    typed = lens.trip_lens(spark, SF_SMALL)
    lean = star.key_trips(typed, order_cols=lens.NATURAL_KEY, keep=list(TRIP_COLUMNS))
    assert not any("-input" in path for path, _ in written)
    assert not any(set(lens.NATURAL_KEY) & set(columns) for _, columns in written)
    whole = star.key_trips(lens.as_landing_text(typed), order_cols=lens.NATURAL_KEY)
    assert sum("-input" in path for path, _ in written) == 1  # text is coerced once
    assert same_rows(lean, whole.select(*lean.columns))


def test_a_ranking_without_a_copy_keeps_ties_nulls_and_columns(spark):
    rows = spark.createDataFrame([(None, 1, "a"), (2, None, "b"), (2, None, "b"), (1, 5, "c"), (None, None, "d")], "k int, v int, t string")
    for copy in (True, False):
        stage = stage_ranked(rows, ["k", F.desc("v")], copy=copy, keep=["t"])
        assert "k" not in stage.rows.columns and stage.row_count() == 5
        got = star.attach_dense_id(stage).orderBy("trip_id").collect()
        assert [(r.trip_id, r.t) for r in got] == [(1, "c"), (2, "b"), (3, "b"), (4, "a"), (5, "d")]
        stage.release()


def test_landings_are_packed_and_loaded_without_a_copy(spark, written):
    loader = registry._loaded_in_three(spark, SF_SMALL)
    landed = [n for n in os.listdir(loader.landing_dir.replace("file:", "")) if ".csv" in n and not n.startswith(".")]
    assert landed and all(n.endswith(".csv.gz") for n in landed)
    assert not any("-input" in path for path, _ in written)
    assert not any(set(lens.NATURAL_KEY) & set(columns) for path, columns in written if "trips-batch" in path)
    plain = IncrementalStarLoader(spark, scratch_path(spark, "landing"), scratch_path(spark, "wh"),
                                  order_cols=lens.NATURAL_KEY, extra_types=lens.NATURAL_KEY_TYPES)
    for part in registry._landings(spark, SF_SMALL):
        sink_files.land_csv(part, plain.landing_dir)
        plain.run_available()
    for name in ("fact", "pickup", "dropoff", "date", "analysis"):
        assert same_rows(loader.table(name), plain.table(name)), name


def test_a_packed_landing_is_cut_by_rows_and_reads_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink_files, "PACKED_ROWS", 1_000)
    rows = lens.raw_trip_lens(spark, SF_SMALL).coalesce(1).withColumn("VendorID", F.when(F.col("l_linenumber") == 1, 'a, "b"').otherwise(F.col("VendorID")))
    sink_files.land_csv(rows, str(tmp_path / "plain"))
    sink_files.land_csv(rows, str(tmp_path / "packed"), compression="gzip")
    sizes = [{n: os.path.getsize(tmp_path / d / n) for n in os.listdir(tmp_path / d) if n.startswith("part")} for d in ("plain", "packed")]
    assert len(sizes[1]) == -(-rows.count() // 1_000) and 3 * sum(sizes[1].values()) < sum(sizes[0].values())
    read = [spark.read.schema(raw_schema(lens.NATURAL_KEY_TYPES)).option("header", True).option("enforceSchema", False).csv(str(tmp_path / d))
            for d in ("plain", "packed")]
    assert same_rows(*read)


def test_a_bucketed_load_makes_copies_of_its_key_behind_the_shuffle(spark, monkeypatch):
    plans = []
    real = DataFrameWriter.insertInto

    def insert(self, *args, **kwargs):
        plans.append(plan(self._df))
        real(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "insertInto", insert)
    rows = spark.range(50).select("id", F.col("id").alias("same"), (F.col("id") * 2).alias("v"), F.col("id").alias("also"))
    table = unique_name("copied")
    truncate_load(rows, table, scratch_path(spark, "wh"), bucket_by="id", buckets=4, copies=("same", "also"))
    moved = re.search(r"Exchange\nInput \[\d+\]: \[(.*)\]", plans[0]).group(1)
    assert "same" not in moved and "also" not in moved and "v#" in moved
    assert spark.table(table).columns == ["id", "same", "v", "also"]
    assert sorted(map(tuple, spark.table(table).collect())) == [(i, i, 2 * i, i) for i in range(50)]


def test_a_load_of_typed_rows_counts_them_once(spark, written):
    typed = lens.trip_lens(spark, SF_SMALL).withColumn("tip_amount", F.when(F.col("l_linenumber") > 2, F.col("tip_amount")))
    n = typed.count()
    loaded, counts = warehouse.load_with_counts(spark, typed, "_" + unique_name("typed"), scratch_path(spark, "wh"), order_cols=lens.NATURAL_KEY)
    assert counts["landing"] == counts["typed"] == counts["FactTable"] == n == spark.table(loaded["FactTable"]).count()
    assert {k: v for k, v in counts.items() if k.startswith("nulled")} == {f"nulled {c}": 0 for c in TRIP_COLUMNS}
    assert not any("-input" in path for path, _ in written)
    text = warehouse.load_with_counts(spark, lens.as_landing_text(typed), "_" + unique_name("text"), scratch_path(spark, "wh"), order_cols=lens.NATURAL_KEY)
    assert text[1] == counts
