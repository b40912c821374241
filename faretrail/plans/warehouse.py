"""End-to-end star build: landing trips -> 7 warehouse tables -> analysis.

One staging of the keyed trips feeds the fact and both location dimensions
(and the date dimension); the three literal dimensions are ``VALUES``
tables.  All seven are replaced together under one name suffix (see
:mod:`faretrail.sinks.versions`), and the analysis reads exactly the tables
that one build wrote.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.functions.coerce import is_typed
from faretrail.functions.keys import RankedStage
from faretrail.operators import star
from faretrail.operators.observed import LandingCounts
from faretrail.plans.analysis import trip_locations, vendor_trip_counts
from faretrail.schemas import DROPOFF_ID, PICKUP_ID, TRIP_COLUMNS
from faretrail.sinks.versions import TableSet, Version, set_of_view
from faretrail.sources import literals

# Warehouse table names in load order (fixed contract), before the suffix.
TABLE_NAMES = [
    "FactTable",
    "PaymentTypesDim",
    "PickupLocationsDim",
    "DropOffLocationsDim",
    "DateDim",
    "RateCodesDim",
    "VendorsDim",
]


# Bucket column per trip-keyed table: both location ids are copies of the trip id, so the
# three tables are bucketed alike and join in place.
BUCKET_KEYS = {
    "FactTable": "trip_id",
    "PickupLocationsDim": "pickup_location_id",
    "DropOffLocationsDim": "dropff_location_id",
}
ID_COPIES = {"FactTable": (PICKUP_ID, DROPOFF_ID)}


@dataclass
class StarTables:
    trips: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stages: list[RankedStage] = field(default_factory=list)
    landing: LandingCounts | None = None

    def release(self) -> None:
        """Remove the staged trips; the tables above can't be read after."""
        for stage in self.stages:
            stage.release()


def build_star(spark: SparkSession, raw: DataFrame, order_cols: list[str] | None = None,
               key: str = "dense", date_dim_form: str = "single", keep: list[str] | None = None) -> StarTables:
    """Type and key ``raw`` once, then derive the seven tables lazily.  ``keep``: the columns
    that ``trips`` has besides its ids, all of them by default; the tables need the contract's."""
    stages: list[RankedStage] = []
    landing = LandingCounts()
    ranked = key == "dense" and order_cols is not None and is_typed(raw)
    # typed rows are ranked without a copy, so what observes them would see them twice: they lose
    # no value to their types, and their number is that of the ranking
    trips = star.key_trips(raw if ranked else landing.typed(raw), order_cols=order_cols, key=key, stages=stages, keep=keep,
                           copy=not ranked)
    if ranked:
        landing.lossless(raw, stages[0].row_count)
    dates = {"single": star.date_dim, "prededup": star.date_dim_prededup,
             "dedup_rows": star.date_dim_dedup_rows}[date_dim_form](trips)
    tables = {
        "FactTable": star.fact_trips(trips),
        "PaymentTypesDim": literals.payment_type_dim(spark),
        "PickupLocationsDim": star.pickup_location_dim(trips),
        "DropOffLocationsDim": star.dropoff_location_dim(trips),
        "DateDim": dates,
        "RateCodesDim": literals.rate_code_dim(spark),
        "VendorsDim": literals.vendor_dim(spark),
    }
    return StarTables(trips, tables, stages, landing)


def star_set(spark: SparkSession, suffix: str = "", location_root: str | None = None) -> TableSet:
    """The seven tables of a suffix; by default under the session's warehouse folder."""
    root = location_root or spark.conf.get("spark.sql.warehouse.dir")
    return TableSet(spark, f"{root.rstrip('/')}/star{suffix}", suffix)


def open_star(spark: SparkSession, suffix: str = "", location_root: str | None = None) -> dict[str, str]:
    """Name -> catalog table of the last load of a suffix, all of one version.  Without
    ``location_root`` the folder is that of the published views."""
    root = None if location_root else set_of_view(spark, f"{TABLE_NAMES[0]}{suffix}")
    return (TableSet(spark, root, suffix) if root else star_set(spark, suffix, location_root)).names()


def load_star(built: StarTables, suffix: str = "", location_root: str | None = None,
              buckets: int | None = None) -> dict[str, str]:
    """Replace all seven tables in one step; returns name -> catalog table of this load.

    The views ``<name><suffix>`` follow for SQL users.  A load that is stopped anywhere leaves
    the tables of the load before, which :func:`open_star` gives together.

    ``buckets``: also bucket the trip-keyed tables on their ids (one hash
    shuffle each at load time), so the location analysis over the loaded
    tables joins all three without shuffling any.
    Worth it when the analysis runs more often than the load.
    """
    tables, version = _switched(built, suffix, location_root, buckets)
    return tables.names(version)


def _switched(built: StarTables, suffix: str, location_root: str | None,
              buckets: int | None = None) -> tuple[TableSet, Version]:
    tables = star_set(built.trips.sparkSession, suffix, location_root)
    keys = {name: (key, buckets) for name, key in BUCKET_KEYS.items()} if buckets else None
    version = tables.load({name: built.tables[name] for name in TABLE_NAMES}, keys, copies=ID_COPIES)
    tables.publish({name: f"{name}{suffix}" for name in TABLE_NAMES})
    return tables, version


def build_and_load(spark: SparkSession, raw: DataFrame, suffix: str = "", location_root: str | None = None,
                   order_cols: list[str] | None = None, buckets: int | None = None,
                   key: str = "dense") -> dict[str, str]:
    """The load step as a whole: build, replace, and remove what was staged, also on failure."""
    built = build_star(spark, raw, order_cols=order_cols, key=key, keep=list(TRIP_COLUMNS))
    try:
        return load_star(built, suffix, location_root, buckets)
    finally:
        built.release()


def load_with_counts(spark: SparkSession, raw: DataFrame, suffix: str = "", location_root: str | None = None,
                     order_cols: list[str] | None = None, key: str = "dense") -> tuple[dict[str, str], dict[str, int]]:
    """The load step, and the rows at each of its steps: ``landing``, ``typed``, every table by
    name, and ``nulled <column>``, values that the types turned to NULL.  All are counted by the
    tasks that load; nothing is scanned for them."""
    built = build_star(spark, raw, order_cols=order_cols, key=key, keep=list(TRIP_COLUMNS))
    try:
        tables, version = _switched(built, suffix, location_root)
        seen = built.landing.get()
        counts = {"landing": seen.pop("landing"), "typed": version.tables["FactTable"].rows}
        counts |= {name: entry.rows for name, entry in version.tables.items()}
        counts |= {f"nulled {c}": n for c, n in seen.items()}
        return tables.names(version), counts
    finally:
        built.release()


def table_counts(spark: SparkSession, loaded: dict[str, str]) -> DataFrame:
    """(table_name, row_count) per loaded table, read back from the warehouse."""
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, t in loaded.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def analyse_loaded(spark: SparkSession, loaded: dict[str, str]) -> DataFrame:
    """The analysis step over exactly the tables a build just loaded."""
    return vendor_trip_counts(spark.table(loaded["FactTable"]), spark.table(loaded["VendorsDim"]))


def analyse_locations_loaded(spark: SparkSession, loaded: dict[str, str],
                             strategy: str = "auto") -> DataFrame:
    """The location analysis (fact joined to both location dimensions) read
    from the loaded warehouse tables.  :func:`build_star` copies the trip id into both location
    ids, so all three join on it, in place where they are bucketed."""
    return trip_locations(spark.table(loaded["FactTable"]), spark.table(loaded["PickupLocationsDim"]),
                          spark.table(loaded["DropOffLocationsDim"]), strategy, copied_ids=True)


def build_load_analyse(spark: SparkSession, raw: DataFrame, suffix: str,
                       location_root: str | None = None,
                       order_cols: list[str] | None = None) -> DataFrame:
    """Load step then analysis step, handing the suffix from one to the other."""
    return analyse_loaded(spark, build_and_load(spark, raw, suffix, location_root, order_cols))
