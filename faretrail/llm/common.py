"""Shared pieces of the text operators: row keys, staged tables, word reading."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import faretrail
from faretrail.session import drop_scratch, scratch_path

#: Internal columns carry this prefix, so they never meet a column of the caller.
ID, TH, TEXT = "_ft_id", "_ft_th", "_ft_text"
#: Order of a null id: before every other.
LOWEST = -(2**63)
#: Bytes of text that one numpy pass inside a task holds at most (one text may be longer).
CHUNK_BYTES = 4 << 20


def id_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text hash, text): the key under which results meet their rows again.

    Rows equal in id and text share a key and so one result; rows of one id with
    different texts are different documents, ordered by the hash.  A null id sorts first.
    """
    return docs.select(id_key(id_col).alias(ID), text_hash(text_col).alias(TH),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT))


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The caller's columns and the two key columns."""
    return docs.withColumns({ID: id_key(id_col), TH: text_hash(text_col)})


def original_id() -> Column:
    """The id as it came in: null again where it was null."""
    return F.when(F.col(ID) != LOWEST, F.col(ID))


#: Tables staged by the innermost open :func:`staging`: their sessions, by path.
_STAGED: ContextVar[dict[str, SparkSession] | None] = ContextVar("staged", default=None)


@contextmanager
def staging() -> Iterator[Callable[..., None]]:
    """Tables written inside are removed at the end, after an error too, but for those given to
    the ``keep`` that this yields: a scope around takes them over, and without one they stay.

    An operator keeps what its lazy result reads.  A caller that writes the result inside a
    scope of its own leaves nothing else behind: ``with staging(): op(docs).write.parquet(...)``.
    """
    outer, own, kept = _STAGED.get(), {}, set()
    token = _STAGED.set(own)
    try:
        yield lambda *tables: kept.update(t._ft_path for t in tables)
    except BaseException:
        kept.clear()
        raise
    finally:
        _STAGED.reset(token)
        for path, spark in own.items():
            if path not in kept:
                drop_scratch(spark, path)
            elif outer is not None:
                outer[path] = spark


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: a fixed result that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    if (staged := _STAGED.get()) is not None:
        staged[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ft_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Remove a table of :func:`written` that no later step reads."""
    drop_scratch(df.sparkSession, df._ft_path)
    if (staged := _STAGED.get()) is not None:
        staged.pop(df._ft_path, None)


def chunks(texts: list[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of together about ``limit`` characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: bytes.split() cuts at exactly these six."""
    return text.encode("utf-8", "surrogatepass").split()


#: What the operators of this Python worker remember between batches, by operator.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembering(operator: str, forget: Callable[[], None] = lambda: None) -> None:
    """Called in a task before its work: a worker keeps the word caches of one operator at a
    time, and those of the others are emptied."""
    for other in [k for k in _REMEMBERED if k != operator]:
        _REMEMBERED.pop(other)()
    _REMEMBERED[operator] = forget


def series_of(texts: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in texts]


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            most: int, *more: str) -> DataFrame:
    """(text, label, *more) of at most ``most`` labelled documents, written.

    Those with the smallest hash of the id are taken from the labels alone, so only their
    ids (a bounded number) are sent to the scan of the texts.  Rows of one id count once.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias(ID)).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64(ID), ID).limit(most))
    found = (docs.select(F.col(id_col).cast("long").alias(ID), F.struct(F.col(text_col).cast("string").alias("text"), *more).alias("row"))
             .join(F.broadcast(chosen), ID))
    rows = found.groupBy(ID, "label").agg(F.min("row").alias("row"))
    # dealt by the id, which is there once, so that copies of a text don't meet
    return written(rows.repartition(24, F.xxhash64(ID)).select("label", "row.*"), "labelled")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as --py-files does; once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_faretrail_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(faretrail.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="faretrail-zip-"), "faretrail_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("faretrail", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._faretrail_shipped = True
