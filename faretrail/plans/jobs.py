"""Job entry points: one callable per warehouse job, plus a command line.

Each load job reads landing trips, builds the star from one staging and
truncate-loads the seven tables under a suffix; the analysis job reads the
tables of a suffix.  Run on a cluster with ``spark-submit`` (package shipped
with ``--py-files faretrail.zip``):

    spark-submit --py-files faretrail.zip faretrail/plans/jobs.py load-csv "s3://bucket/trips/*.csv" --suffix ""
    spark-submit ... faretrail/plans/jobs.py load-parquet s3://bucket/trips-parquet/ --suffix _parq --buckets 4096
    spark-submit ... faretrail/plans/jobs.py load-catalog trips_hive --suffix _partitioned \\
        --catalog-predicate "year = '2023' and month = '5'" --push-down-predicate "date >= 28"
    spark-submit ... faretrail/plans/jobs.py csv-to-parquet s3://bucket/trips/ s3://bucket/trips-parquet/
    spark-submit ... faretrail/plans/jobs.py compact s3://bucket/trips-parquet/ --target-bytes 63333990
    spark-submit ... faretrail/plans/jobs.py analyse --suffix _partitioned
    spark-submit ... faretrail/plans/jobs.py analyse-locations --suffix _partitioned --table analysis_table
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from faretrail.plans import warehouse
from faretrail.sinks.compaction import TARGET_BYTES, compact
from faretrail.sinks.files import csv_to_parquet
from faretrail.sinks.tables import truncate_load
from faretrail.sources.files import read_partitioned, read_trips_csv, read_trips_parquet


def _load(spark: SparkSession, raw: DataFrame, suffix: str, location_root: str | None,
          order_cols: list[str] | None, buckets: int | None = None,
          key: str = "dense") -> dict[str, str]:
    return warehouse.build_and_load(spark, raw, suffix, location_root, order_cols, buckets, key)


def load_csv(spark: SparkSession, path: str, suffix: str = "", location_root: str | None = None,
             order_cols: list[str] | None = None, buckets: int | None = None,
             key: str = "dense") -> dict[str, str]:
    """Header CSV landing (no inference pass) -> star tables ``<name><suffix>``."""
    return _load(spark, read_trips_csv(spark, path), suffix, location_root, order_cols, buckets, key)


def load_parquet(spark: SparkSession, path: str, suffix: str = "_parq",
                 location_root: str | None = None, recursive: bool = False,
                 order_cols: list[str] | None = None, buckets: int | None = None,
             key: str = "dense") -> dict[str, str]:
    """Parquet landing (text or typed columns) -> star tables."""
    raw = read_trips_parquet(spark, path, recursive=recursive)
    return _load(spark, raw, suffix, location_root, order_cols, buckets, key)


def load_catalog(spark: SparkSession, source: str, suffix: str = "_partitioned",
                 catalog_predicate: str | None = None, push_down_predicate: str | None = None,
                 is_table: bool = True, location_root: str | None = None,
                 order_cols: list[str] | None = None, buckets: int | None = None,
             key: str = "dense") -> dict[str, str]:
    """Partitioned landing table, pruned by partition predicates -> star tables.
    The partition columns reach the typed frame and are dropped by the
    fact/dimension projections."""
    raw = read_partitioned(spark, source, catalog_predicate, push_down_predicate, is_table)
    return _load(spark, raw, suffix, location_root, order_cols, buckets, key)


def convert_csv_to_parquet(spark: SparkSession, src: str, dst: str, mode: str = "errorifexists") -> None:
    csv_to_parquet(spark, src, dst, mode)


def analyse(spark: SparkSession, suffix: str = "", location_root: str | None = None) -> DataFrame:
    """Trips per vendor over the tables of the last load under ``suffix``, all of one load."""
    return warehouse.analyse_loaded(spark, warehouse.open_star(spark, suffix, location_root))


def analyse_locations(spark: SparkSession, suffix: str = "", table: str | None = None,
                      location: str | None = None, location_root: str | None = None) -> DataFrame:
    """Fact joined to both location dimensions of the last load under ``suffix``;
    truncate-loaded into ``table`` when given."""
    result = warehouse.analyse_locations_loaded(spark, warehouse.open_star(spark, suffix, location_root))
    if table:
        truncate_load(result, table, location)
        return spark.table(table)
    return result


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="faretrail.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("load-csv", "load-parquet", "load-catalog"):
        j = sub.add_parser(name)
        j.add_argument("source")
        j.add_argument("--suffix", default=None)
        j.add_argument("--location-root", default=None)
        j.add_argument("--buckets", type=int, default=None,
                       help="bucket the trip-keyed tables on their ids")
        j.add_argument("--key", choices=("dense", "files", "monotonic"), default="dense",
                       help="files: ids by file and place in it, the same however the files are split")
        j.add_argument("--order-cols", nargs="+", default=None,
                       help="natural key; without it, ids follow the scan and nothing is sorted")
        if name == "load-parquet":
            j.add_argument("--recursive", action="store_true")
        if name == "load-catalog":
            j.add_argument("--catalog-predicate", default=None)
            j.add_argument("--push-down-predicate", default=None)
            j.add_argument("--path", action="store_true", help="source is a folder, not a table")
    c = sub.add_parser("csv-to-parquet")
    c.add_argument("src")
    c.add_argument("dst")
    a = sub.add_parser("analyse")
    a.add_argument("--suffix", default="")
    a.add_argument("--location-root", default=None)
    al = sub.add_parser("analyse-locations")
    al.add_argument("--suffix", default="")
    al.add_argument("--table", default="analysis_table")
    al.add_argument("--location", default=None)
    al.add_argument("--location-root", default=None)
    pk = sub.add_parser("compact")
    pk.add_argument("folder")
    pk.add_argument("--target-bytes", type=int, default=TARGET_BYTES)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"faretrail-{args.job}").getOrCreate()
    if args.job == "load-csv":
        load_csv(spark, args.source, args.suffix if args.suffix is not None else "", args.location_root,
                 buckets=args.buckets, key=args.key, order_cols=args.order_cols)
    elif args.job == "load-parquet":
        load_parquet(spark, args.source, args.suffix if args.suffix is not None else "_parq",
                     args.location_root, args.recursive, buckets=args.buckets, key=args.key, order_cols=args.order_cols)
    elif args.job == "load-catalog":
        load_catalog(spark, args.source, args.suffix if args.suffix is not None else "_partitioned",
                     args.catalog_predicate, args.push_down_predicate, not args.path,
                     args.location_root, buckets=args.buckets, key=args.key, order_cols=args.order_cols)
    elif args.job == "csv-to-parquet":
        convert_csv_to_parquet(spark, args.src, args.dst)
    elif args.job == "analyse-locations":
        analyse_locations(spark, args.suffix, args.table, args.location, args.location_root)
    elif args.job == "compact":
        replaced, made = compact(spark, args.folder, args.target_bytes)
        print(f"{replaced} files packed into {made}")
    else:
        analyse(spark, args.suffix, args.location_root).show(truncate=False)


if __name__ == "__main__":
    main()
