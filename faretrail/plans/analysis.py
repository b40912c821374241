"""Analysis queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.operators.aggregates import grouped_count
from faretrail.operators.joins import broadcast_bounded, join, join_on, salted_join
from faretrail.schemas import (ANALYSIS_COLUMNS, ANALYSIS_FIELD_PATHS, DROPOFF_ID, PICKUP_ID, TRIP_ID,
                               resolve_column)


def vendor_trip_counts(fact: DataFrame, vendors: DataFrame) -> DataFrame:
    """Trips per vendor, named.

    Counts first (partial aggregation map-side, a shuffle of one row per task
    and vendor), then joins the count rows to the vendor dimension.  No hint:
    the literal ``VALUES`` dimension carries exact statistics, so Catalyst
    broadcasts it on a proven size, while a large user-supplied dimension gets a
    shuffle join (and AQE still broadcasts the aggregated side when it turns out
    small).  NULL and unknown vendors are counted but have no dimension row, so
    the inner join drops them.  The key is emitted once.
    """
    counts = grouped_count(fact, "vendorid", "vendorid", "count")
    named = counts.join(vendors, counts["vendorid"] == vendors["VendorID"], "inner")
    return named.select(counts["vendorid"].alias("vendorid"), F.col("count"),
                        vendors["VendorName"].alias("vendorname"))


def trip_vendor(fact: DataFrame, vendors: DataFrame, strategy: str = "auto",
                fact_rows: int | None = None) -> DataFrame:
    """Each trip with its vendor name; ``strategy`` picks the physical join.

    ``auto`` lets the exact statistics of the literal dimension broadcast it.
    ``merge`` and ``shuffle_hash`` shuffle both sides with a salt, as two or
    three vendors would otherwise be two or three tasks.  ``broadcast_fact``
    sends the trips to the vendors, where ``fact_rows`` of the two columns
    stay below :data:`faretrail.operators.joins.BROADCAST_BYTES`, and is a
    salted shuffle join beyond.  Rows are the same under every strategy.
    """
    if strategy == "broadcast_fact":
        small = broadcast_bounded(fact.select("trip_id", "VendorID"), fact_rows)
        if small is not None:
            return join(small, vendors, "VendorID").select("trip_id", "VendorID", "VendorName")
        strategy = "shuffle_hash"
    joined = (join(fact, vendors, "VendorID") if strategy == "auto"
              else salted_join(fact, vendors, "VendorID", strategy))
    return joined.select("trip_id", "VendorID", "VendorName")


def trip_locations(fact: DataFrame, pickup: DataFrame, dropoff: DataFrame,
                   strategy: str = "auto", copied_ids: bool = False) -> DataFrame:
    """Fact joined to both location dimensions -> the 11-column analysis table.

    Both dimensions are as large as the fact, so by default neither is
    broadcast: AQE plans shuffle joins on the bigint ids (and switches to a
    broadcast at run time only if a side turns out small).

    ``copied_ids``: the fact's location ids are its trip id (as ``key_trips``
    makes them), so both joins are on the trip id and one distribution by it
    serves all three tables, none if they are bucketed so.
    """
    if copied_ids:
        j1 = join(fact, pickup.withColumnRenamed(PICKUP_ID, "_pickup"), F.col(TRIP_ID) == F.col("_pickup"), "inner", strategy)
        j2 = join(j1, dropoff.withColumnRenamed(DROPOFF_ID, "_dropoff"), F.col(TRIP_ID) == F.col("_dropoff"), "inner", strategy)
        return j2.select(*[F.col(resolve_column(j2.columns, c)).alias(c) for c in ANALYSIS_COLUMNS])
    j1 = join(fact, pickup, "pickup_location_id", "inner", strategy)
    j2 = join(j1, dropoff, "dropff_location_id", "inner", strategy)
    return j2.select(*[F.col(resolve_column(j2.columns, c)).alias(c) for c in ANALYSIS_COLUMNS])


def trip_locations_renamed(fact: DataFrame, pickup: DataFrame, dropoff: DataFrame,
                           strategy: str = "auto", copied_ids: bool = False) -> DataFrame:
    """Same analysis rows via renamed dimension keys and path-list joins:
    ``pickup_location_id2`` / ``dropff_location_id2`` joined to the fact's
    ids, then the 11 fields selected by name.  ``copied_ids`` as in :func:`trip_locations`."""
    p2 = pickup.withColumnRenamed("pickup_location_id", "pickup_location_id2")
    d2 = dropoff.withColumnRenamed("dropff_location_id", "dropff_location_id2")
    own = [[TRIP_ID], [TRIP_ID]] if copied_ids else [[PICKUP_ID], [DROPOFF_ID]]
    j1 = join_on(fact, p2, own[0], ["pickup_location_id2"], strategy=strategy)
    j2 = join_on(j1, d2, own[1], ["dropff_location_id2"], strategy=strategy)
    return j2.select(*[F.col(resolve_column(j2.columns, c)).alias(c) for c in ANALYSIS_FIELD_PATHS])


def rate_code_counts(fact: DataFrame, rate_codes: DataFrame) -> DataFrame:
    """Trips per rate code, named.  The dimension stores its key as text and
    the fact as int; the text key is cast explicitly on the dimension side
    (after the fact is aggregated), never per fact row.  Join strategy from
    statistics, as in :func:`vendor_trip_counts`."""
    counts = grouped_count(fact, "RatecodeID", "RatecodeID", "count")
    dim = rate_codes.select(F.col("RatecodeID").try_cast("int").alias("rc_key"), "RatecodeName")
    named = counts.join(dim, counts["RatecodeID"] == dim["rc_key"], "inner")
    return named.select("RatecodeID", "RatecodeName", "count")
