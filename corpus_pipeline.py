"""From raw documents to packed token sequences, stage by stage.

Each stage is one operator of ``faretrail.llm``, works on all that the one before kept, and is
written as Parquet and read again.  All but the last return the columns of ``documents``;
``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.llm import lines, packing, simhash, substring, toxicity
from faretrail.llm.common import drop_written, staging, written
from faretrail.llm.queries import TOXIC_FROM, table, toxic_lexicon


def _counted(before: DataFrame, after: DataFrame) -> DataFrame:
    if "n_chars" not in after.columns:
        return after
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores as toxic go; all others stay as they are."""
    lexicon = toxic_lexicon(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scored(F.col("text"), lexicon) < TOXIC_FROM)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for their first; all documents stay."""
    return _counted(docs, lines.without_recurring_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def drop_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of words that occur earlier go; all documents stay."""
    return _counted(docs, substring.without_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_recurring_lines),
    ("near copies", drop_near_copies),
    ("repeated runs", drop_repeated_runs),
    ("packing", pack),
]

#: SQL can't express the fingerprints, the learned lexicon and the tokens; the tests hold the
#: rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  Of what is staged, the last stage's table
    stays; that of each other goes when the next is written, all if one fails."""
    docs, before = table(spark, sf_dir, "documents"), None
    with staging() as keep:
        for name, stage in STAGES:
            with staging() as own:
                docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
                own(docs)
            if before is not None:
                drop_written(before)
            before = docs
        keep(docs)
    return docs
