"""Exact top-k by inner product over a pivot-distance index.

The vectors are centred, which moves all scores of a query alike, and one more coordinate gives
them the same norm; so the best score is the smallest angle, and angles keep the triangle
inequality.  Vectors are keyed by nearest pivot and ring of the angle to it.  Each ring knows its
least and greatest angle to every pivot, and the widest gap to the query's own angle bounds the
scores in it.  A query reads its rings in the order of these bounds, in growing rounds, and stops
where the next bound falls below its k-th score.  A round shuffles only rings that a query still
asks for, each as often as its queries fill tasks.

The bound needs near neighbours to prune.  Vectors without any (independent directions in many
dimensions) have no ring that can be ruled out: answers stay exact, and all rings are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretrail.llm.common import LOWEST, drop_written, written

PIVOTS, RINGS = 64, 8
#: Vectors that the centre, the pivots and the edges of their rings are taken from (those with the
#: smallest hash); every vector is indexed.
SAMPLE = 8_192
#: Vectors, and queries, that meet in one task.
BLOCK = 16_384
#: Rings that a query reads in the first round, and how much wider each further round is.
FIRST, WIDER = 4, 4


@dataclass
class Index:
    """rows (vec_id, v, ring) in a written table; per ring its least and greatest angle to each
    pivot and its size; ``visits``: (query, ring) pairs read by the rounds of the last search."""

    rows: DataFrame
    space: Space
    least: np.ndarray
    greatest: np.ndarray
    size: np.ndarray
    visits: list[int] = field(default_factory=list)


@dataclass
class Space:
    """The centred and widened space of the index, and its pivots there as unit vectors."""

    centre: np.ndarray
    top: float
    pivots: np.ndarray

    @property
    def width(self) -> int:
        return len(self.centre)

    def placed(self, m: np.ndarray) -> np.ndarray:
        """The rows of ``m`` as unit vectors."""
        x = m.astype(float) - self.centre
        return np.column_stack([x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0.0))]) / math.sqrt(self.top)

    def asked(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Angles of queries to the pivots; what a score is beside the cosine, as factor and term."""
        q = m.astype(float)
        norm = np.sqrt((q * q).sum(axis=1))
        unit = np.column_stack([q, np.zeros(len(q))]) / np.maximum(norm, 1.0)[:, None]
        return _angles(unit, self.pivots), norm * math.sqrt(self.top), q @ self.centre


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = 256) -> DataFrame:
    """(vec_id, v): floor(factor * x) of every component as double; rows whose vector is null
    or holds a null or non-finite component are left out."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.where(x.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * factor)).cast("array<long>").alias("v")))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v[:width]
    return out


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _norm(v: str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))


def _largest(rows: DataFrame, centre: np.ndarray) -> float:
    """The largest square norm about ``centre``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], len(centre)) - centre
            yield pd.DataFrame({"top": [float((x * x).sum(axis=1).max(initial=0.0))]})

    return rows.select("v").mapInPandas(run, "top double").agg(F.max("top")).first()[0]


def build(scaled_rows: DataFrame, pivots: int = PIVOTS, rings: int = RINGS) -> Index | None:
    """The index of all rows of :func:`scaled`; None for an empty table.

    Shorter vectors count as filled up with zeros.  Components of which a product could pass 64
    bits are refused with a ValueError."""
    rows = written(scaled_rows, "vectors")
    width, longest, n = rows.agg(F.max(F.size("v")), F.max(_norm("v")), F.count("*")).first()
    if not n:
        drop_written(rows)
        return None
    if longest >= 2.0 ** 63:
        drop_written(rows)
        raise ValueError("vectors too long: a score could pass 64 bits")
    sample = _matrix(rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).toPandas()["v"], width)
    centre = sample.mean(axis=0)
    space = Space(centre, _largest(rows, centre) * (1 + 1e-9) + 1, np.zeros((0, width + 1)))
    wide = space.placed(sample)
    chosen = [0]
    nearest = _angles(wide, wide[:1])[:, 0]
    while len(chosen) < min(pivots, len(wide)) and nearest.max() > 1e-6:  # the farthest one, again and again
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _angles(wide, wide[chosen[-1:]])[:, 0])
    space.pivots = wide[chosen]
    angles = _angles(wide, space.pivots)
    own = angles.argmin(axis=1)
    edges = [np.quantile(angles[own == p, p], np.arange(1, rings) / rings) for p in range(len(chosen))]

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = _angles(space.placed(_matrix(b["v"], width)), space.pivots)
            p = d.argmin(axis=1)
            ring = [x * rings + int(np.searchsorted(edges[x], y)) for x, y in zip(p, d.min(axis=1), strict=True)]
            yield b.assign(ring=np.array(ring, np.int32))

    ringed = written(rows.mapInPandas(keyed, "vec_id long, v array<long>, ring int"), "ringed")
    drop_written(rows)
    n_rings, n_pivots = rings * len(chosen), len(chosen)

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lo, hi, size = np.full((n_rings, n_pivots), np.inf), np.full((n_rings, n_pivots), -np.inf), np.zeros(n_rings, np.int64)
        for b in batches:
            d, ring = _angles(space.placed(_matrix(b["v"], width)), space.pivots), b["ring"].to_numpy()
            np.minimum.at(lo, ring, d)
            np.maximum.at(hi, ring, d)
            size += np.bincount(ring, minlength=n_rings)
        at = np.flatnonzero(size)
        ring, pivot = np.repeat(at, n_pivots), np.tile(np.arange(n_pivots), len(at))
        yield pd.DataFrame({"ring": ring.astype(np.int32), "pivot": pivot.astype(np.int32),
                            "lo": lo[at].ravel(), "hi": hi[at].ravel(), "n": size[ring]})

    least, greatest, size = np.full((n_rings, n_pivots), np.inf), np.full((n_rings, n_pivots), -np.inf), np.zeros(n_rings, np.int64)
    for r in (ringed.mapInPandas(bounds, "ring int, pivot int, lo double, hi double, n long")
              .groupBy("ring", "pivot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).collect()):
        least[r["ring"], r["pivot"]], greatest[r["ring"], r["pivot"]], size[r["ring"]] = r["lo"], r["hi"], r["n"]
    return Index(ringed, space, least, greatest, size)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while they stay below 2**53, else in integers."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    if q.shape[1] * float(np.abs(q).max()) * float(np.abs(v).max()) < 2 ** 53:
        return (q.astype(float) @ v.astype(float).T).astype(np.int64)
    return q @ v.T


def _ordered(index: Index, asked: DataFrame) -> DataFrame:
    """``asked`` with the rings in the order of their bounds: order (most, ring)."""
    space, full = index.space, np.flatnonzero(index.size)
    least, greatest = index.least[full], index.greatest[full]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1024):
                own = b.iloc[at:at + 1024]
                d, factor, term = space.asked(_matrix(own["v"], space.width))
                gap = np.zeros((len(own), len(full)))
                for p in range(d.shape[1]):
                    np.maximum(gap, least[:, p] - d[:, p:p + 1], out=gap)
                    np.maximum(gap, d[:, p:p + 1] - greatest[:, p], out=gap)
                most = factor[:, None] * np.cos(np.maximum(gap - 1e-6, 0.0)) + term[:, None]
                most += 1e-6 * (factor + np.abs(term))[:, None] + 1
                order = np.argsort(-most, axis=1, kind="stable")
                yield own.assign(order=[[{"most": float(m[x]), "ring": int(full[x])} for x in o]
                                        for m, o in zip(most, order, strict=True)])

    return asked.mapInPandas(run, "query_id long, qh long, v array<long>, order array<struct<most: double, ring: int>>")


def _visit(index: Index, wanted: DataFrame, k: int) -> DataFrame:
    """(query_id, qh, vec_id, score): the k best of each block for each query that visits it.
    ``wanted``: query_id, qh, v, ring."""
    width = index.space.width
    queries = np.zeros(len(index.size), np.int64)
    for r in wanted.groupBy("ring").count().collect():  # at most pivots * rings of them
        queries[r["ring"]] = r["count"]
    index.visits.append(int(queries.sum()))
    parts, blocks = -(-queries // BLOCK), np.maximum(-(-index.size // BLOCK), 1)

    def of_ring(x: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(int(y)) for y in x]), F.col("ring"))

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(rows):
            ids = rows["vec_id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], _matrix(rows["v"], width)[order]
            for lo in range(0, len(queries), 512):
                own = queries.iloc[lo:lo + 512]
                s = _scores(_matrix(own["v"], width), m)
                for row, i, h in zip(s, own["query_id"], own["qh"], strict=True):
                    others = ids != i
                    if others.sum() > k:  # all that tie with the k-th
                        at = np.flatnonzero(others & (row >= np.partition(row[others], -k)[-k]))
                    else:
                        at = np.flatnonzero(others)
                    at = at[np.lexsort((ids[at], -row[at]))][:k]
                    out.append((np.full(len(at), i), np.full(len(at), h), ids[at], row[at]))
        columns = zip(*out, strict=True) if out else [[np.empty(0, np.int64)]] * 4
        return pd.DataFrame({c: np.concatenate(list(x)) for c, x in zip(("query_id", "qh", "vec_id", "score"), columns, strict=True)})

    key = ["ring", "block", "part"]
    rows = (index.rows.withColumn("parts", of_ring(parts)).where("parts > 0")
            .select(F.coalesce("vec_id", F.lit(LOWEST)).alias("vec_id"), "v", "ring",
                    F.pmod(F.monotonically_increasing_id(), of_ring(blocks)).cast("int").alias("block"),
                    F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part")))
    asking = (wanted.withColumn("part", F.pmod(F.xxhash64("query_id", "qh"), of_ring(parts)).cast("int"))
              .select("query_id", "qh", "v", "ring", "part", F.explode(F.sequence(F.lit(0), (of_ring(blocks) - 1).cast("int"))).alias("block")))
    return (asking.groupBy(*key).cogroup(rows.groupBy(*key))
            .applyInPandas(meet, "query_id long, qh long, vec_id long, score long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row (vec_id, v) of
    ``queries``, ties to the smaller vec_id; rows with the query's own id take no part.
    A repeated query is answered once; repeated rows are candidates each; a null vec_id of a
    row counts as the smallest and comes back as null.  Components of a query beyond the
    longest vector count for nothing.  Queries of which a product could pass 64 bits are refused
    with a ValueError."""
    space = index.space
    asked = (queries.where("vec_id is not null").select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("qh"), "v")
             .dropDuplicates(["query_id", "qh"]))
    left = written(_ordered(index, asked), "queries")
    longest = left.agg(F.max(_norm("v"))).first()[0] or 0.0
    reach = math.sqrt(space.top) + float(np.linalg.norm(space.centre))  # no vector is longer
    if math.sqrt(longest) * reach >= 2.0 ** 63:
        drop_written(left)
        raise ValueError("queries too long: a score could pass 64 bits")
    index.visits.clear()
    best, step = None, FIRST
    while best is None or not left.isEmpty():
        wanted = left.select("query_id", "qh", "v", F.explode(F.slice("order", 1, step)).alias("x")).select("query_id", "qh", "v", "x.ring")
        found = _visit(index, wanted, k)
        now = written(_best(found if best is None else best.drop("rank").unionByName(found), k), "answers")
        least = now.where(F.col("rank") == k).select("query_id", "qh", F.col("score").alias("least"))
        rest = F.filter(F.slice("order", step + 1, len(index.size)), lambda x: F.col("least").isNull() | (x["most"] >= F.col("least")))
        then = written(left.join(least, ["query_id", "qh"], "left").select("query_id", "qh", "v", rest.alias("order"))
                       .where(F.size("order") > 0), "queries")
        for old in (left, best):
            if old is not None:
                drop_written(old)
        left, best, step = then, now, step * WIDER
    drop_written(left)
    return best.select("query_id", "rank", F.when(F.col("vec_id") != LOWEST, F.col("vec_id")).alias("vec_id"), "score")


def top_k(vectors: DataFrame, queries: DataFrame | None = None, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5) -> DataFrame:
    """Top k of ``vectors`` for each of ``queries`` (by default the rows whose id is divisible
    by 50).  An empty table gives no rows."""
    rows = scaled(vectors, id_col, vec_col)
    asked = rows.where("vec_id % 50 = 0") if queries is None else scaled(queries, id_col, vec_col)
    index = build(rows)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = search(index, asked, k)
    drop_written(index.rows)
    return found
