"""Star schema derivation: typed-and-keyed trips -> fact and dimension tables.

``key_trips`` types the landing columns, assigns the surrogate trip id and
its two location-id copies, and stages the result once in the shared folder.
Every table below is a column-pruned projection of that one staging, so the
fact and both location dimensions always agree on ids (and the source is
scanned once, not once per table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.functions.coerce import is_typed, type_trips
from faretrail.functions.dates import date_labels
from faretrail.functions.keys import (RankedStage, attach_dense_id, monotonic_key, stage_file_positions, stage_positions,
                                      stage_ranked)
from faretrail.session import scratch_path
from faretrail.schemas import (DROPOFF_DIM_COLUMNS, DROPOFF_ID, FACT_COLUMNS,
                               PICKUP_DIM_COLUMNS, PICKUP_ID, TRIP_ID)


def with_location_ids(keyed: DataFrame) -> DataFrame:
    """Both location ids are copies of the trip id (1:1 with the fact)."""
    return (keyed.withColumn(PICKUP_ID, F.col(TRIP_ID))
            .select("*", F.col(TRIP_ID).alias(DROPOFF_ID)))


def key_trips(raw: DataFrame, order_cols: list[str] | None = None,
              key: str = "dense", start: int = 1,
              stages: list[RankedStage] | None = None, keep: list[str] | None = None,
              copy: bool | None = None) -> DataFrame:
    """Typed trips with ``trip_id``, ``pickup_location_id``, ``dropff_location_id``.

    ``key='dense'``: deterministic 1-based rank over ``order_cols``.  Without a
    natural key (``order_cols=None``) the order is that of the scan: dense ids
    1..n without any shuffle.  ``key='files'``: dense ids by file and place in it, without a
    shuffle and independent of the splits, for rows that are read straight from files.
    ``key='monotonic'``: the sparse split-dependent id.

    ``stages`` collects what was staged; its owner releases it after the load.  ``keep``: the
    columns that the keyed trips have besides their ids (all of them by default); with a natural
    key no others are staged.

    ``copy``: whether the trips are written before they are ranked (see ``stage_ranked``); by
    default where there is text to coerce, which would be coerced twice.
    """
    typed = type_trips(raw)
    if keep and (key != "dense" or order_cols is None):
        typed = typed.select(*keep)
    if key == "monotonic":
        # staged once, so every derived table sees the same split-dependent ids
        path = scratch_path(raw.sparkSession, "trips-monotonic")
        monotonic_key(typed).write.parquet(path)
        keyed = raw.sparkSession.read.parquet(path)
        if stages is not None:
            stages.append(RankedStage(keyed, keyed, (path,)))
    elif key in ("dense", "files"):
        if key == "files":
            stage = stage_file_positions(typed, "trips")
        else:
            stage = (stage_positions(typed, "trips") if order_cols is None
                     else stage_ranked(typed, order_cols, "trips", copy=not is_typed(raw) if copy is None else copy, keep=keep))
        if stages is not None:
            stages.append(stage)
        keyed = attach_dense_id(stage, start=start)
        keyed = keyed.select(TRIP_ID, *[c for c in keyed.columns if c != TRIP_ID])
    else:
        raise ValueError(f"unknown key kind {key!r}")
    return with_location_ids(keyed)


def fact_trips(trips: DataFrame) -> DataFrame:
    return trips.select(*FACT_COLUMNS)


def pickup_location_dim(trips: DataFrame) -> DataFrame:
    return trips.select(*PICKUP_DIM_COLUMNS)


def dropoff_location_dim(trips: DataFrame) -> DataFrame:
    return trips.select(*DROPOFF_DIM_COLUMNS)


def union_timestamps(trips: DataFrame) -> DataFrame:
    """Pickup and drop-off timestamps stacked into one ``datekey`` column
    (the rows of ``UNION ALL``, NULLs kept).

    Built as one pass that emits two rows per trip, so the input is read (or
    its join computed) once instead of once per branch.
    """
    return trips.select(F.explode(F.array("tpep_pickup_datetime", "tpep_dropoff_datetime"))
                        .alias("datekey"))


def date_dim(trips: DataFrame) -> DataFrame:
    """One row per distinct pickup/drop-off timestamp, with calendar labels.

    Deduplicates the one-column key first and derives labels after: the
    labels are functions of ``datekey``, and a one-column shuffle is the
    cheapest; partial aggregation collapses repeated timestamps map-side, so
    a timestamp shared by a third of all trips is no hot spot.
    """
    keys = union_timestamps(trips).distinct()
    return keys.select("datekey", *date_labels("datekey"))


def date_dim_prededup(trips: DataFrame, partitions: int | None = None) -> DataFrame:
    """Date dimension in the pre-deduplicated form: each timestamp branch
    deduplicated on its own, then the union deduplicated again.  Same rows as
    :func:`date_dim`, two more aggregations in the plan.

    ``partitions`` narrows each deduplicated branch to that many partitions.
    The narrowing comes *after* the branch's dedup: a ``coalesce`` in front
    of it would be narrow and cap the scan of the whole fact at ``partitions``
    tasks.  Default: AQE sizes the partitions.
    """
    def branch(col: str) -> DataFrame:
        keys = trips.select(F.col(col).alias("datekey")).distinct()
        return keys.coalesce(partitions) if partitions else keys

    keys = branch("tpep_pickup_datetime").union(branch("tpep_dropoff_datetime")).distinct()
    return keys.select("datekey", *date_labels("datekey"))


def date_dim_dedup_rows(trips: DataFrame) -> DataFrame:
    """Date dimension via labels first, then ``dropDuplicates()`` on whole rows."""
    labelled = union_timestamps(trips).select("datekey", *date_labels("datekey"))
    return labelled.dropDuplicates()
