"""Seven tables that change together: stopped loads, readers, removal of old versions."""

import pytest
from pyspark.sql import functions as F

from faretrail import storage
from faretrail.plans import jobs, warehouse
from faretrail.session import scratch_path, shared_dir, unique_name
from faretrail.sinks import versions
from faretrail.sinks.tables import truncate_load
from faretrail.sources import lens
from tests.conftest import SF_SMALL


class Stopped(BaseException):
    """As good as a kill: nothing in the library may catch it and go on."""


def counts(spark, names):
    return {n: spark.table(t).count() for n, t in names.items()}


@pytest.fixture(scope="module")
def trips(spark):
    path = scratch_path(spark, "trips")
    lens.raw_trip_lens(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def loaded(spark, rows, root, suffix, **how):
    return warehouse.build_and_load(spark, rows, suffix, root, order_cols=lens.NATURAL_KEY, **how)


@pytest.mark.parametrize("at", range(7))
def test_a_load_stopped_between_any_two_tables_leaves_the_seven_old_ones(spark, trips, monkeypatch, at):
    root, suffix = scratch_path(spark, "wh"), "_" + unique_name("v")
    small = trips.where("l_linenumber = 1")
    old = counts(spark, loaded(spark, small, root, suffix))
    done = []

    def stopping(df, table, *args, **how):
        if len(done) == at:
            raise Stopped
        done.append(table)
        return truncate_load(df, table, *args, **how)

    with monkeypatch.context() as m:
        m.setattr(versions, "truncate_load", stopping)
        # a killed process cleans nothing up
        m.setattr(versions.storage, "delete", lambda *a: None)
        m.setattr(warehouse.StarTables, "release", lambda self: None)
        with pytest.raises(Stopped):
            loaded(spark, trips, root, suffix)
    names = warehouse.open_star(spark, suffix, root)
    assert counts(spark, names) == old == counts(spark, {n: f"{n}{suffix}" for n in warehouse.TABLE_NAMES})
    ids = [{r[0] for r in spark.table(names[n]).select(c).collect()} for n, c in
           (("FactTable", "trip_id"), ("PickupLocationsDim", "pickup_location_id"), ("DropOffLocationsDim", "dropff_location_id"))]
    assert ids[0] == ids[1] == ids[2]
    tables = warehouse.star_set(spark, suffix, root)
    assert len(tables.sweep()) == (1 if at else 0) and tables.sweep() == []
    assert counts(spark, loaded(spark, trips, root, suffix))["FactTable"] == trips.count()


def test_a_load_stopped_before_and_after_its_commit(spark, trips, monkeypatch):
    root, suffix = scratch_path(spark, "wh"), "_" + unique_name("v")
    small = trips.where("l_linenumber = 1")
    old = counts(spark, loaded(spark, small, root, suffix))
    with monkeypatch.context() as m:
        m.setattr(versions.storage, "write_once", lambda *a: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            loaded(spark, trips, root, suffix)
    assert counts(spark, warehouse.open_star(spark, suffix, root)) == old
    with monkeypatch.context() as m:  # committed, but the views were not moved
        m.setattr(versions.TableSet, "publish", lambda *a: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            loaded(spark, trips, root, suffix)
    now = counts(spark, warehouse.open_star(spark, suffix, root))
    assert now["FactTable"] == now["PickupLocationsDim"] == trips.count() > old["FactTable"]
    assert jobs.analyse(spark, suffix).agg(F.sum("count")).first()[0] == trips.where("VendorID IN ('1', '2')").count()
    warehouse.star_set(spark, suffix, root).publish({n: f"{n}{suffix}" for n in warehouse.TABLE_NAMES})
    assert spark.table(f"FactTable{suffix}").count() == trips.count()


def test_a_failing_load_removes_what_it_wrote(spark, monkeypatch):
    root = scratch_path(spark, "set")
    tables = versions.TableSet(spark, root, "_" + unique_name("f"))
    tables.load({"a": spark.range(3), "b": spark.range(4)})
    before = set(storage.names(spark, root)), {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="boom"):
        tables.load({"a": spark.range(30), "b": spark.range(4).select(F.raise_error(F.lit("boom")).alias("id"))})
    assert (set(storage.names(spark, root)), {t.name for t in spark.catalog.listTables()}) == before
    assert [spark.table(t).count() for t in tables.names().values()] == [3, 4]


def test_of_two_loads_at_a_time_one_is_committed(spark, monkeypatch):
    root = scratch_path(spark, "set")
    tables, other = (versions.TableSet(spark, root, "_" + unique_name("c")) for _ in range(2))
    real = versions.storage.write_once

    def late(*args):
        monkeypatch.setattr(versions.storage, "write_once", real)
        other.load({"a": spark.range(2)})
        return real(*args)

    monkeypatch.setattr(versions.storage, "write_once", late)
    with pytest.raises(RuntimeError, match="another load"):
        tables.load({"a": spark.range(5)})
    assert spark.table(tables.names()["a"]).count() == 2


def test_old_versions_go_and_readers_keep_theirs(spark):
    root = scratch_path(spark, "set")
    tables = versions.TableSet(spark, root, "_" + unique_name("o"))
    for n in range(1, 5):
        version = tables.load({"a": spark.range(n)}, keep=2)
        assert version.number == n and version.tables["a"].rows == n
    before = spark.table(tables.names(tables.version(3))["a"])
    assert before.count() == 3 and tables.version(2) is None
    assert len([n for n in storage.names(spark, root) if n != "_commits"]) == 2
    with pytest.raises(ValueError):
        versions.TableSet(spark, scratch_path(spark, "none")).names()


def test_another_catalog_registers_the_tables_with_their_buckets(spark):
    root = scratch_path(spark, "set")
    tables = versions.TableSet(spark, root, "_" + unique_name("r"))
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("s"))
    name = tables.load({"a": rows}, {"a": ("k", 3)}).tables["a"].table
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the table is external
    again = tables.names()["a"]
    assert again == name and spark.table(again).count() == 100
    from faretrail.sinks.tables import bucket_spec
    assert bucket_spec(spark, again) == ("k", 3)


def test_views_don_t_take_the_place_of_a_table(spark):
    name = unique_name("own")
    truncate_load(spark.range(2), name, scratch_path(spark, "wh") + "/" + name)
    tables = versions.TableSet(spark, scratch_path(spark, "set"))
    tables.load({"a": spark.range(3)})
    with pytest.raises(ValueError, match="table of its own"):
        tables.publish({"a": name})
    assert spark.table(name).count() == 2


def test_a_load_leaves_no_staging(spark, trips):
    folder = shared_dir(spark) + "/faretrail"
    before = set(storage.names(spark, folder))
    root = scratch_path(spark, "wh")
    _, seen = warehouse.load_with_counts(spark, trips, "_" + unique_name("s"), root, order_cols=lens.NATURAL_KEY)
    assert set(storage.names(spark, folder)) - before == {root.rsplit("/", 1)[1]}
    n = trips.count()
    assert seen["landing"] == seen["typed"] == seen["FactTable"] == n and seen["VendorsDim"] == 2
    assert not any(v for k, v in seen.items() if k.startswith("nulled"))


def test_counts_of_a_load_take_no_scan_of_their_own(spark, trips):
    """Jobs of a load with and without asking for the counts."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs_of(run):
        group = unique_name("group")
        sc.setJobGroup(group, group)
        try:
            run()
            return len(tracker.getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    how = {"location_root": scratch_path(spark, "wh"), "order_cols": lens.NATURAL_KEY}
    plain = jobs_of(lambda: warehouse.build_and_load(spark, trips, "_" + unique_name("j"), **how))
    counted = jobs_of(lambda: warehouse.load_with_counts(spark, trips, "_" + unique_name("j"), **how))
    assert counted <= plain


def test_lost_values_are_counted_by_column(spark):
    rows = [("1", "2.5", "2020-01-01 00:00:00", "x"), ("one", None, "no day", "3"), (None, "n/a", None, "4"), ("7", "", "2020-01-02", "5")]
    raw = spark.createDataFrame(rows, "vendorid string, trip_distance string, tpep_pickup_datetime string, note string")
    from faretrail.operators.observed import LandingCounts
    seen = LandingCounts()
    passing = seen.over(raw)
    assert passing.columns == raw.columns
    passing.write.format("noop").mode("overwrite").save()
    assert seen.get() == {"landing": 4, "VendorID": 1, "trip_distance": 2, "tpep_pickup_datetime": 1}


def test_a_load_coerces_and_counts_in_one_typing(spark):
    rows = [("1", "2.5", "2020-01-01 00:00:00", "x"), ("one", None, "no day", "3"), (None, "n/a", None, "4"), ("7", "", "2020-01-02", "5")]
    raw = spark.createDataFrame(rows, "vendorid string, trip_distance string, tpep_pickup_datetime string, note string")
    from faretrail.functions.coerce import type_trips
    from faretrail.operators.observed import LandingCounts
    from tests.test_plans import plan
    seen = LandingCounts()
    typed = seen.typed(raw)
    assert typed.schema == type_trips(raw).schema
    assert "try_cast" not in "".join(n for n in plan(typed).splitlines() if "CollectMetrics" in n).lower()
    typed.write.format("noop").mode("overwrite").save()
    assert seen.get() == {"landing": 4, "VendorID": 1, "trip_distance": 2, "tpep_pickup_datetime": 1}
