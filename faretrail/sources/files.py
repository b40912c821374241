"""File sources: header CSV, Parquet (plain, glob, recursive) and Hive-style
partitioned layouts with partition pruning."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretrail import storage
from faretrail.schemas import resolve_column, spark_type


def read_trips_csv(spark: SparkSession, path: str | list[str],
                   extra_types: dict[str, str] | None = None,
                   file_glob: str | None = None) -> DataFrame:
    """Header CSV, columns named by the header and read as text (no inference
    pass over the data); ``extra_types`` casts pass-through columns by name.

    ``path`` may itself be a glob (``.../trips-1996-*.csv``); ``file_glob``
    narrows the files of a directory by name.
    """
    # every file's header is held against the names read from the first: a file with other or
    # re-ordered columns fails instead of giving values of the wrong column
    reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    df = reader.csv(path)
    for name, typ in (extra_types or {}).items():
        df = df.withColumn(name, F.col(name).try_cast(spark_type(typ)))
    return df


def split_bytes(spark: SparkSession, path: str, suffix: str, least: int, most_splits: int) -> int:
    """Size of the splits in which to read the files under ``path``: ``least`` bytes, or more where
    that would make over ``most_splits`` of them, as every split is a task."""
    held = storage.listing(spark, path, suffix).agg(F.sum("length")).first()[0] or 0
    return max(least, -(-held // most_splits))


def read_csv_by_header(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame | None:
    """Rows of header CSV files whose headers may differ, in the columns of ``schema``.

    The files are grouped by their header line, which alone is read here, and each group is
    scanned by its own names (upper and lower case alike).  A column that a file lacks is NULL, one
    that the schema lacks is left out, values that their type refuses are NULL.  Empty files have
    no rows; a header that names a column twice is an error.  None without any file with a header.
    """
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda p: storage.first_line(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, lines, strict=True):
        if line.strip():
            groups.setdefault(tuple(c.strip() for c in next(csv.reader([line]))), []).append(path)
    frames = []
    for header, own in sorted(groups.items()):
        if len({c.lower() for c in header}) < len(header):
            raise ValueError(f"a column stands twice in the header of {own[0]}: {header}")
        rows = (spark.read.option("header", True).schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
                .csv([storage.literal(p) for p in own]))
        picked = []
        for f in schema.fields:
            name = resolve_column(list(header), f.name)
            value = F.col(f"`{name}`") if name in header else F.lit(None)
            picked.append((value if f.dataType == T.StringType() and name in header else value.try_cast(f.dataType)).alias(f.name))
        frames.append(rows.select(*picked))
    return reduce(DataFrame.unionByName, frames) if frames else None


def read_trips_parquet(spark: SparkSession, path: str | list[str],
                       recursive: bool = False) -> DataFrame:
    """Parquet directory or glob.  ``recursive`` walks nested folders without
    partition discovery.  Small files are bin-packed into splits by Spark
    itself, sized by the session's ``spark.sql.files.maxPartitionBytes`` and
    ``spark.sql.files.openCostInBytes`` (set them at submit time)."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def register_partitioned_table(spark: SparkSession, name: str, path: str,
                               fmt: str = "parquet") -> str:
    """Register a ``col=value/...`` folder as a catalog table and record the
    partitions present on storage (rerun after new folders land)."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def read_partitioned(spark: SparkSession, source: str,
                     catalog_predicate: str | None = None,
                     push_down_predicate: str | None = None,
                     is_table: bool = False) -> DataFrame:
    """Scan a ``year=/month=/date=`` layout (path) or a partitioned table.

    Both predicates reference partition columns only, so they become
    ``PartitionFilters`` of the scan and whole directories are skipped.
    Partition-type inference stays on: unpadded day folders must compare as
    numbers (``date >= 28`` must not match ``date=3``).
    """
    df = spark.table(source) if is_table else spark.read.parquet(source)
    for pred in (catalog_predicate, push_down_predicate):
        if pred:
            df = df.where(F.expr(pred))
    return df
