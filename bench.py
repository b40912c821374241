"""Benchmark: headline warehouse queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is executed to completion through the ``noop`` sink (full
computation, nothing collected to the driver) and timed wall-clock; headline
queries report the median of ``$BENCH_REPEAT`` runs (default 3) to damp JIT and
GC noise.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "3")))

HEADLINE = [
    "vendor_trip_counts",        # flagship: count per vendor, then broadcast join to the dim
    "vendor_counts",
    "row_count",
    "lenient_casts",
    "surrogate_key_dense",
    "fact_trips",
    "dim_date",
    "dim_date_prededup",
    "trip_vendor_broadcast_dim",
    "trip_vendor_broadcast_fact",
    "trip_vendor_sortmerge",
    "trip_locations",
    "rate_code_counts",
    "scan_csv",
    "scan_parquet",
    "sink_truncate_load",
    "star_build_counts",
    "loaded_vendor_trip_counts",  # load step then analysis step, one suffix
    "loaded_trip_locations",      # bucketed load, then the location join over it
    "incremental_load",
]


def sf_label(path: str) -> str:
    base = os.path.basename(path)
    return base[2:] if base.startswith("sf") else base


def run(spark, fn) -> float:
    if isinstance(fn, tuple):  # (untimed setup, timed query over its result)
        setup, query = fn
        state = setup(spark, SF_DIR)
        fn = lambda s, sf: query(s, state)
    t = time.perf_counter()
    out = fn(spark, SF_DIR)
    for df in (out if isinstance(out, (list, tuple)) else [out]):
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def variants():
    """
    staging vs per-table recomputation, single vs pre-deduplicated date dim."""
    from faretrail import registry
    from faretrail.functions.keys import monotonic_key
    from faretrail.operators import star
    from faretrail.plans import analysis
    from faretrail.sources import lens, literals

    def with_conf(conf, fn):
        def wrapped(spark, sf):
            old = {k: spark.conf.get(k) for k in conf}
            for k, v in conf.items():
                spark.conf.set(k, v)
            try:
                out = fn(spark, sf)
                for df in (out if isinstance(out, (list, tuple)) else [out]):
                    df.write.format("noop").mode("overwrite").save()
                return []
            finally:
                for k, v in old.items():
                    spark.conf.set(k, v)
        return wrapped

    def trip_vendor_auto(spark, sf):
        fact = star.fact_trips(registry._warehouse_trips(spark, sf))
        return analysis.trip_vendor(fact, literals.vendor_dim(spark), "auto")

    def star_staged(spark, sf):
        trips = star.key_trips(lens.raw_trip_lens(spark, sf), order_cols=lens.NATURAL_KEY)
        return [star.fact_trips(trips), star.pickup_location_dim(trips),
                star.dropoff_location_dim(trips), star.date_dim(trips)]

    def star_recomputed(spark, sf):
        # the unstaged form: every table re-reads and re-types the landing rows
        # and re-evaluates its own split-dependent ids
        def typed():
            t = monotonic_key(star.type_trips(lens.raw_trip_lens(spark, sf)))
            return star.with_location_ids(t)
        return [star.fact_trips(typed()), star.pickup_location_dim(typed()),
                star.dropoff_location_dim(typed()), star.date_dim(typed())]

    from faretrail.plans import warehouse
    from faretrail.session import scratch_path, unique_name

    def loaded_tables(buckets):
        def setup(spark, sf):
            built = warehouse.build_star(spark, lens.trip_lens(spark, sf), order_cols=lens.NATURAL_KEY)
            return warehouse.load_star(built, "_" + unique_name("bench"),
                                       scratch_path(spark, "bench-wh"), buckets=buckets)
        return setup

    def locations_no_broadcast(spark, loaded):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            warehouse.analyse_locations_loaded(spark, loaded).write.format("noop").mode("overwrite").save()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        return []

    aqe_off = {"spark.sql.adaptive.enabled": "false"}
    return {
        "location_analysis_over_unbucketed_tables": (loaded_tables(None), locations_no_broadcast),
        "location_analysis_over_bucketed_tables": (loaded_tables(8), locations_no_broadcast),
        "aqe_off:vendor_trip_counts": with_conf(aqe_off, registry.vendor_trip_counts),
        "aqe_on:trip_vendor_auto": trip_vendor_auto,
        "aqe_off:trip_vendor_auto": with_conf(aqe_off, trip_vendor_auto),
        "aqe_off:trip_vendor_sortmerge": with_conf(aqe_off, registry.queries()["trip_vendor_sortmerge"]),
        "star_tables_one_staging_dense_ids": star_staged,
        "star_tables_recomputed_monotonic_ids": star_recomputed,
        "date_dim_single_dedup": registry.queries()["dim_date"],
        "date_dim_prededup_44": registry.queries()["dim_date_prededup"],
    }


def main() -> None:
    from faretrail import registry
    from faretrail.session import build_session

    spark = build_session(f"local[{CPUS}]", max(CPUS, 8), app_name="faretrail-bench")
    qs = registry.queries()
    names = sys.argv[1:] or HEADLINE
    run(spark, qs["row_count"])  # warm-up: JIT, file listing caches
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(spark, qs[name]) for _ in range(REPEAT)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    extra = {}
    if not sys.argv[1:] and os.environ.get("BENCH_VARIANTS", "1") == "1":
        for name, fn in variants().items():
            if name.startswith("_"):
                continue
            extra[name] = round(run(spark, fn), 3)
            print(f"# variant {name}: {extra[name]}s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_label(SF_DIR),
        "cpus": CPUS,
        "repeat": REPEAT,
        "variants": extra,
    }))


if __name__ == "__main__":
    main()
