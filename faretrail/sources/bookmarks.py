"""Bookmarked scans: of a Parquet folder or a partitioned catalog table, only files not yet loaded.

The files are listed without opening them, partition predicates first, and anti-joined with a
manifest of the files that earlier runs have loaded (path, size, time; a file written anew
counts as new).  A run's files join the manifest after its load, as one folder of its number, so
a run that stops is repeated under the same number.  Loads must replace what they wrote under
that number before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail import storage

#: What tells a file: name, bytes, time of writing in microseconds.
FILE = ["path", "length", "modified"]
MANIFEST = "path string, length long, modified long"


def table_location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    if found is None:
        raise ValueError(f"{table} has no folder")
    return found["data_type"]


class BookmarkedScan:
    """What ``source`` holds beyond the manifest under ``state``.

    ``source``: a folder, flat or in ``col=value/`` folders, or with ``is_table`` a partitioned
    catalog table, of which only registered partitions are seen.  The predicates are on partition
    columns; other files stay unread until a run without them.
    """

    def __init__(self, spark: SparkSession, source: str, state: str, is_table: bool = False,
                 catalog_predicate: str | None = None, push_down_predicate: str | None = None, suffix: str = ".parquet"):
        self.spark = spark
        self.source = source
        self.state = state.rstrip("/")
        self.is_table = is_table
        self.predicates = [p for p in (catalog_predicate, push_down_predicate) if p]
        self.suffix = suffix
        self.folder = table_location(spark, source) if is_table else source.rstrip("/")

    def listed(self) -> DataFrame:
        """(path, length, modified) of all files that the predicates leave."""
        files = storage.listing(self.spark, self.folder, self.suffix)
        for p in self.predicates:  # on partition columns: whole folders drop out of the listing
            files = files.where(F.expr(p))
        files = files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))
        if self.is_table:
            known = self.spark.sql(f"SHOW PARTITIONS {self.source}").select(F.col("partition").alias("_folder"))
            own = F.regexp_extract("path", r"((?:[^/=]+=[^/]*/)+)[^/]*$", 1)
            files = files.withColumn("_folder", F.rtrim(own, F.lit("/"))).join(known, "_folder", "left_semi").drop("_folder")
        return files

    def _runs(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in storage.names(self.spark, self.state)
                      if n.startswith("run=") and storage.exists(self.spark, f"{self.state}/{n}/_SUCCESS"))

    def consumed(self) -> DataFrame | None:
        """The manifest: files of all finished runs."""
        runs = self._runs()
        if not runs:
            return None
        return self.spark.read.schema(MANIFEST).parquet(*[f"{self.state}/run={r}" for r in runs])

    def pending(self, max_files: int | None = None) -> DataFrame:
        """Files that no finished run has loaded; with ``max_files`` the oldest of them."""
        files, done = self.listed(), self.consumed()
        if done is not None:
            files = files.join(done, FILE, "left_anti")
        return files if max_files is None else files.orderBy("modified", "path").limit(max_files)

    def read(self, paths: list[str]) -> DataFrame:
        """Rows of some files, with the partition columns of their folders."""
        reader = self.spark.read.option("basePath", self.folder)
        if self.is_table:
            reader = reader.schema(self.spark.table(self.source).schema)
        return reader.parquet(*[storage.literal(p) for p in paths])

    def run(self, load: Callable[[DataFrame, int], None], max_files: int | None = None) -> int:
        """Hand the rows of the pending files to ``load(rows, run number)``, then record them;
        returns the number of files.  With nothing pending nothing is read.

        The names of a run's files pass through the driver, which plans every scan by them;
        ``max_files`` bounds a run, the rest is left to the next ones."""
        number = (self._runs() or [-1])[-1] + 1
        found = sorted(tuple(r) for r in self.pending(max_files).collect())
        if not found:
            return 0
        load(self.read([p for p, _, _ in found]), number)
        rows = self.spark.createDataFrame(found, MANIFEST)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.state}/run={number}")
        return len(found)
