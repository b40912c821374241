"""Tables that are replaced together.

Every load writes all its tables to a folder of its own and then one commit record that names
them.  The record appears in one step, and readers take the tables of the last record, so they
see all tables of one load or all of another, whenever a load is stopped.  An unfinished load
leaves files that no record names.

Layout under ``root``: ``_commits/<number>.json`` and ``<attempt>/<table>/``.  The tables are
catalog tables too (``<name>__<attempt>``), which carry the bucketing; a session whose catalog
doesn't know them registers them from the record.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from faretrail import storage
from faretrail.sinks.tables import ensure_table, truncate_load

SET_PROPERTY = "faretrail.set"


@dataclass(frozen=True)
class Entry:
    """One table of a version: its catalog name, folder, rows as counted while writing, schema
    and bucketing."""
    table: str
    path: str
    rows: int
    schema: str
    bucket_by: str | None = None
    buckets: int | None = None


@dataclass(frozen=True)
class Version:
    number: int
    attempt: str
    tables: dict[str, Entry]

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "attempt": self.attempt,
                           "tables": {k: asdict(v) for k, v in self.tables.items()}}, indent=1)

    @staticmethod
    def from_json(text: str) -> Version:
        found = json.loads(text)
        return Version(found["number"], found["attempt"], {k: Entry(**v) for k, v in found["tables"].items()})


class TableSet:
    """The tables under ``root``, as of the last commit."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        """``suffix``: behind the names of tables in the catalog."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.suffix = suffix
        self.commits = f"{self.root}/_commits"

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in storage.names(self.spark, self.commits) if n.endswith(".json") and n[:-5].isdigit())

    def _record(self, number: int) -> str:
        return f"{self.commits}/{number:012d}.json"

    def version(self, number: int | None = None) -> Version | None:
        """The last committed version, or that of a number; None before the first commit."""
        numbers = self._numbers()
        if number is None:
            number = numbers[-1] if numbers else None
        return None if number not in numbers else Version.from_json(storage.read_text(self.spark, self._record(number)))

    def load(self, frames: dict[str, DataFrame], buckets: dict[str, tuple[str, int]] | None = None,
             keep: int = 2, copies: dict[str, tuple[str, ...]] | None = None) -> Version:
        """Replace all tables by ``frames`` in one step; the last ``keep`` versions stay for
        readers that have begun.  ``buckets``: (column, count) of the tables to bucket; ``copies``:
        their columns that equal the bucket column (see :func:`faretrail.sinks.tables.truncate_load`).

        A load that fails removes what it wrote and leaves the tables as they were.  Of two loads
        at a time one is committed; the other fails."""
        attempt = uuid.uuid4().hex[:12]
        number = (self._numbers() or [0])[-1] + 1
        made: list[str] = []
        entries: dict[str, Entry] = {}
        try:
            for name, frame in frames.items():
                table, path = f"{name}{self.suffix}__{attempt}", f"{self.root}/{attempt}/{name}"
                bucket_by, count = (buckets or {}).get(name, (None, None))
                made.append(table)
                seen = Observation()
                truncate_load(frame, table, path, bucket_by=bucket_by, buckets=count, observe=seen,
                              copies=(copies or {}).get(name, ()))
                entries[name] = Entry(table, path, int(seen.get.get("rows", 0)), self.spark.table(table).schema.json(), bucket_by, count)
            version = Version(number, attempt, entries)
            if not storage.write_once(self.spark, self._record(number), version.to_json()):
                raise RuntimeError(f"version {number} of {self.root} was committed by another load meanwhile")
        except BaseException:
            committed = self.version(number)
            if committed is not None and committed.attempt == attempt:
                raise  # the record is there, whatever failed in writing it
            for table in made:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            storage.delete(self.spark, f"{self.root}/{attempt}")
            raise
        self._forget(keep)
        return version

    def _forget(self, keep: int) -> None:
        """Remove the versions before the last ``keep``, records last: a removal that is cut
        short goes on at the next load."""
        for number in self._numbers()[:-max(keep, 1)]:
            version = self.version(number)
            for entry in version.tables.values():
                self.spark.sql(f"DROP TABLE IF EXISTS {entry.table}")
            storage.delete(self.spark, f"{self.root}/{version.attempt}")
            storage.delete(self.spark, self._record(number))

    def sweep(self) -> list[str]:
        """Remove the folders of stopped loads; to be called while no load runs."""
        kept = {self.version(n).attempt for n in self._numbers()}
        left = [n for n in storage.names(self.spark, self.root) if n not in kept and not n.startswith(("_", "."))]
        for attempt in left:
            storage.delete(self.spark, f"{self.root}/{attempt}")
        return left

    def names(self, version: Version | None = None) -> dict[str, str]:
        """Name -> catalog table of one version (the last one by default), registered where this
        session's catalog lacks it."""
        version = version or self.version()
        if version is None:
            raise ValueError(f"nothing is committed under {self.root}")
        for entry in version.tables.values():
            if not self.spark.catalog.tableExists(entry.table):
                empty = self.spark.createDataFrame([], T.StructType.fromJson(json.loads(entry.schema)))
                ensure_table(empty, entry.table, entry.path, entry.bucket_by, entry.buckets)
        return {name: entry.table for name, entry in version.tables.items()}

    def publish(self, views: dict[str, str]) -> None:
        """Point the views (table name -> view name) to the last version, for SQL users.

        One statement a view: a reader that needs all tables of one version takes :meth:`names`,
        which a stopped publication doesn't concern; publishing again finishes it."""
        tables = self.names()
        for name, view in views.items():
            if self.spark.catalog.tableExists(view) and self.spark.catalog.getTable(view).tableType != "VIEW":
                raise ValueError(f"{view} is a table of its own; drop or rename it")
        for name, view in views.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{SET_PROPERTY}' = '{self.root}') "
                           f"AS SELECT * FROM {tables[name]}")


def set_of_view(spark: SparkSession, view: str) -> str | None:
    """The root of the set that a published view belongs to."""
    if not spark.catalog.tableExists(view):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {view}").where(f"key = '{SET_PROPERTY}'").first()
    return found["value"] if found else None
