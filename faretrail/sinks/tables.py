"""Truncate-and-load into warehouse tables.

Session-catalog tables: the first load creates the table (schema from the
frame, Parquet at the given location); every load then replaces all rows
with ``INSERT OVERWRITE`` semantics by name, keeping the table, its
location and its schema.  A frame that reads its own target is staged to
the shared folder first (Spark refuses to overwrite a table it is reading).

JDBC tables: ``mode('overwrite')`` + ``truncate=true`` truncates and keeps the
table where the dialect supports it.  Spark drops and recreates the table for
URLs whose dialect it does not know -- check the URL scheme of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from faretrail.functions.keys import STAGED
from faretrail.session import scratch_path


def stage(df: DataFrame, label: str = "stage", paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage).  ``paths`` collects
    where; its owner removes that once no frame built on it is read again."""
    path = scratch_path(df.sparkSession, label)
    if paths is not None:
        paths.append(path)
    df.write.option("compression", STAGED).parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_table(df: DataFrame, table: str, location: str | None = None,
                 bucket_by: str | None = None, buckets: int | None = None) -> None:
    """Create ``table`` with ``df``'s schema unless it exists; optionally
    bucketed (and sorted) on one column."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return
    if bucket_by:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet "
                  f"OPTIONS ('compression' = '{STAGED}') CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {buckets} BUCKETS{where}")
        return
    kwargs = {"path": location} if location else {}
    kwargs["compression"] = STAGED
    spark.catalog.createTable(table, source="parquet", schema=df.schema, **kwargs)


def bucket_spec(spark, table: str) -> tuple[str, int] | None:
    """Bucket column and count of an existing table, from the catalog."""
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if not found.get("Num Buckets"):
        return None
    return found["Bucket Columns"].strip("[]`").split(",")[0].strip("` "), int(found["Num Buckets"])


def truncate_load(df: DataFrame, table: str, location: str | None = None,
                  stage_first: bool = False, bucket_by: str | None = None,
                  buckets: int | None = None, observe: Observation | None = None,
                  copies: tuple[str, ...] = ()) -> str:
    """Replace every row of ``table`` with ``df`` (columns matched by name).

    ``observe`` gets the number of ``rows``, counted by the writing tasks themselves.

    With ``bucket_by``, the table is bucketed on that column: the rows are
    hash-partitioned into exactly ``buckets`` tasks first (the same hash the
    bucketing uses), so each bucket is written as one file, and later joins on
    the column read the buckets in place instead of shuffling the table.  ``copies``: columns
    that equal ``bucket_by`` in every row; they are made again behind the shuffle, not moved by it.
    """
    spark = df.sparkSession
    if bucket_by and not buckets:
        raise ValueError("bucket_by needs a bucket count")
    ensure_table(df, table, location, bucket_by, buckets)
    spec = bucket_spec(spark, table)
    if bucket_by and (spec is None or (spec[0].lower(), spec[1]) != (bucket_by.lower(), buckets)):
        raise ValueError(f"{table} has buckets {spec}, not {(bucket_by, buckets)}")
    src = stage(df, "truncate-load") if stage_first else df
    by_name = {c.lower(): c for c in src.columns}
    target_cols = spark.table(table).columns
    missing = [c for c in target_cols if c.lower() not in by_name]
    if missing:
        raise ValueError(f"frame lacks columns {missing} of {table}")
    out = src.select(*[by_name[c.lower()] for c in target_cols])
    if spec:  # also where the caller names no buckets: one file each, not one per task and bucket
        key = by_name[spec[0].lower()]
        copied = {c: F.col(key) for c in out.columns if bucket_by and c in copies}
        out = out.drop(*copied).repartition(spec[1], key).withColumns(copied).select(*out.columns)
    if observe is not None:
        out = out.observe(observe, F.count(F.lit(1)).alias("rows"))
    out.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return table


def jdbc_truncate_load(df: DataFrame, url: str, table: str, properties: dict[str, str],
                       batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """Truncate ``table`` in the warehouse and load ``df`` (parallel inserts,
    at most ``num_partitions`` concurrent connections)."""
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    w = df.write.mode("overwrite").option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url, table, properties=props)
