"""Lenient coercion: malformed text -> NULL, never an exception (FIXTURES F5)."""

import datetime as dt

from pyspark.sql import functions as F

from faretrail.functions.coerce import (lenient_double, lenient_int, lenient_timestamp,
                                        type_trips)
from faretrail.schemas import TRIP_COLUMNS, raw_schema


def test_lenient_int_matches_legacy_casts(spark):
    cases = [("1", 1), ("1.5", 1), (" 7 ", 7), ("", None), ("bad", None), ("-2.9", -2),
             ("1e3", None), ("99999999999", None), (None, None)]
    df = spark.createDataFrame([(s,) for s, _ in cases], "s string")
    got = [r[0] for r in df.select(lenient_int("s")).collect()]
    assert got == [want for _, want in cases]


def test_lenient_double_and_timestamp(spark):
    df = spark.createDataFrame(
        [("2016-03-01 00:07:55", "1.25"), ("2016-03-01", "bad"), ("notadate", " 3 "), (None, None)],
        "t string, d string")
    rows = df.select(lenient_timestamp("t").alias("t"), lenient_double("d").alias("d")).collect()
    assert [r.t for r in rows] == [dt.datetime(2016, 3, 1, 0, 7, 55), dt.datetime(2016, 3, 1),
                                   None, None]
    assert [r.d for r in rows] == [1.25, None, 3.0, None]


def test_type_trips_types_contract_and_keeps_other_columns(spark):
    schema = raw_schema({"l_orderkey": "long"})
    row = ["2", "2016-03-01 00:07:55", "2016-03-01 00:17:55", "1", "2.5", "-73.9", "40.7",
           "1", "-73.8", "40.6", "1", "9.5", "0.5", "0.5", "2.0", "0", "0.3", "12.8", 42]
    df = type_trips(spark.createDataFrame([row], schema))
    types = dict(df.dtypes)
    assert types["VendorID"] == "int" and types["trip_distance"] == "double"
    assert types["tpep_pickup_datetime"] == "timestamp_ntz"
    assert types["l_orderkey"] == "bigint"
    assert df.columns == list(TRIP_COLUMNS) + ["l_orderkey"]
    r = df.first()
    assert r.VendorID == 2 and r.total_amount == 12.8 and r.l_orderkey == 42


def test_csv_empty_fields_become_null(spark, tmp_path):
    from faretrail.sources.files import read_trips_csv
    path = tmp_path / "null_row.csv"
    path.write_text(",".join(TRIP_COLUMNS) + "\n" + "," * (len(TRIP_COLUMNS) - 1) + "\n")
    df = type_trips(read_trips_csv(spark, str(path)))
    r = df.first()
    assert all(r[c] is None for c in TRIP_COLUMNS)
    assert df.count() == 1


def test_no_python_udf_in_typing_plan(spark):
    df = spark.createDataFrame([("1",)], "VendorID string")
    plan = type_trips(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_zone_less_timestamps_survive_a_dst_gap(spark):
    """02:30 on 2024-03-10 does not exist in New York; nothing may shift it."""
    import datetime as dt

    from faretrail.functions.dates import date_labels, date_text
    from faretrail.sources.lens import as_landing_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS tpep_pickup_datetime")
        text = as_landing_text(df).first()[0]
        assert text == "2024-03-10 02:30:00"
        back = df.select(lenient_timestamp(F.lit(text)).alias("t")).first().t
        assert back == dt.datetime(2024, 3, 10, 2, 30)
        labels = df.select(*date_labels("tpep_pickup_datetime"),
                           date_text("tpep_pickup_datetime").alias("d")).first()
        assert tuple(labels) == (dt.date(2024, 3, 10), "24", "2024", "March", "2024-03-10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_lenient_int_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    digits = st.text(alphabet="0123456789", max_size=12)
    texts = st.builds(lambda sp, sg, w, dot, f, sp2: f"{sp}{sg}{w}{dot}{f}{sp2}",
                      st.sampled_from(["", " "]), st.sampled_from(["", "+", "-"]), digits,
                      st.sampled_from(["", "."]), digits, st.sampled_from(["", "  "]))
    extra = ["1.9999999999999999", "2147483647.99", "2147483648.0", "-2147483648.7", "-.5", "+.", ".", "-.", "\x013.7", "\t7\x02"]

    seen = []

    @settings(max_examples=300, suppress_health_check=list(HealthCheck), deadline=None)
    @given(texts)
    def collect(t):
        seen.append(t)

    collect()
    cases = list(dict.fromkeys(seen + extra))
    df = spark.createDataFrame([(t,) for t in cases], "s string")
    got = {r.s: r.i for r in df.select("s", lenient_int("s").alias("i")).collect()}
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:  # the cast itself, not a model of it
        cast = {r.s: r.i for r in df.selectExpr("s", "cast(s AS int) AS i").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert {t: (got[t], cast[t]) for t in cases if got[t] != cast[t]} == {}


def test_zone_offsets_give_utc_wall_time(spark):
    texts = ["2016-03-01 00:07:55+02:00", "2016-03-01 00:07:55", "2016-03-01T00:07:55Z", "2016-03-01", "00:07:55", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.t and str(r.t) for r in df.select(lenient_timestamp("s").alias("t")).collect()]
            assert got == ["2016-02-29 22:07:55", "2016-03-01 00:07:55", "2016-03-01 00:07:55", "2016-03-01 00:00:00", None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
