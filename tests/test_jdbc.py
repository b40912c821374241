"""Parallel warehouse reads: hash buckets cover every row exactly once.

No database is started here; the bucket predicates are checked with Spark SQL
over an in-memory frame (the same SQL a warehouse would evaluate).
"""

from pyspark.sql import functions as F

from faretrail.sources.jdbc import hash_predicates


def test_hash_predicates_partition_rows(spark):
    df = spark.range(-50, 50).select(F.when(F.col("id") % 17 == 0, None)
                                     .otherwise(F.col("id")).alias("k"))
    preds = hash_predicates("k", 4)
    assert len(preds) == 4
    total = 0
    for p in preds:
        total += df.where(F.expr(p)).count()
    assert total == df.count()
    union = None
    for p in preds:
        part = df.where(F.expr(p))
        union = part if union is None else union.unionAll(part)
    assert union.exceptAll(df).count() == 0 and df.exceptAll(union).count() == 0
