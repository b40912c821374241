"""Counts at the steps of a load, taken by the pass that loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from faretrail.functions.coerce import coerce_column, type_trips
from faretrail.schemas import TRIP_COLUMNS, resolve_column


class LandingCounts:
    """Landing rows, and of every contract column the values that its type turns to NULL.

    The counts are those of the first action over the frame of :meth:`over` or :meth:`typed`, which has to be a pass
    over all rows (the write of the staging)."""

    def __init__(self, columns: dict[str, str] = TRIP_COLUMNS):
        self.columns = columns
        self._seen = Observation()
        self._left: Observation | None = None
        self._rows: Callable[[], int] | None = None
        self._known: dict[str, int] | None = None

    def over(self, raw: DataFrame) -> DataFrame:
        """``raw`` itself, with the counts taken as its rows pass."""
        types = {f.name: f.dataType for f in raw.schema.fields}
        nulled = []
        for name, target in self.columns.items():
            own = resolve_column(raw.columns, name)
            if own in types:
                lost = F.col(own).isNotNull() & coerce_column(own, types[own], target).isNull()
                nulled.append(F.count_if(lost).alias(name))
        return raw.observe(self._seen, F.count(F.lit(1)).alias("landing"), *nulled)

    def typed(self, raw: DataFrame) -> DataFrame:
        """``raw`` in the types of the contract, with the same counts.

        A NULL stays NULL, so what a type has cost a column is its values before less those after:
        every value is coerced once, and counting takes no coercion of its own."""
        types = {f.name: f.dataType for f in raw.schema.fields}
        own = {name: resolve_column(raw.columns, name) for name in self.columns}
        own = {name: column for name, column in own.items() if column in types}
        before = raw.observe(self._seen, F.count(F.lit(1)).alias("landing"), *[F.count(F.col(c)).alias(n) for n, c in own.items()])
        self._left = Observation()
        return type_trips(before, self.columns).observe(self._left, F.count(F.lit(1)).alias("landing"), *[F.count(F.col(n)).alias(n) for n in own])

    def lossless(self, typed: DataFrame, rows: Callable[[], int]) -> None:
        """The counts of rows that have their types already: ``rows()`` in all, no value lost."""
        own = {name: resolve_column(typed.columns, name) for name in self.columns}
        self._rows, self._known = rows, {name: 0 for name, c in own.items() if c in typed.columns}

    def get(self) -> dict[str, int]:
        """``landing``, then column -> values lost; waits for the pass."""
        if self._known is not None:
            return {"landing": self._rows()} | self._known
        seen = {k: int(v) for k, v in self._seen.get.items()}
        if self._left is not None:
            left = self._left.get
            seen = {k: v if k == "landing" else v - int(left.get(k, 0)) for k, v in seen.items()}
        return seen
