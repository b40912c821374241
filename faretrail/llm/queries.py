"""The registered queries of the text operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faretrail.llm import (language, lines, linkgraph, outliers, packing, periods, pivots, quality, resampling, sentencepieces, simhash,
                           substring, toxicity)
from faretrail.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]
QUALITY_FROM, TOXIC_FROM = 0.3, 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def _graded(docs: DataFrame, held_out: Column, score: Column, at: float) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= at).cast("int")))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, round_trip of every whole text."""
    return sentencepieces.digest(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; the machine sees labels of four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold("doc_id", 5, 0)
    machine = quality.learn(docs, labels.where(~held_out), n_chars_col="n_chars")
    return _graded(docs, held_out, quality.scored(F.col("text"), machine, F.col("n_chars")), QUALITY_FROM)


def toxic_lexicon(docs: DataFrame, labels: DataFrame) -> toxicity.Lexicon:
    return toxicity.learn(docs, labels.where(~in_fold("doc_id", 3, 1)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; the lexicon sees labels of two folds of three."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxic_lexicon(docs, table(spark, sf_dir, "labels"))
    return _graded(docs, in_fold("doc_id", 3, 1), toxicity.scored(F.col("text"), lexicon), TOXIC_FROM)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(table(spark, sf_dir, "embeddings"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judged(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with periodic words from some place on in every tenth document, as its id's crc32
    (h) says: with g = h // 10, each word i from a = g % n on becomes word a + (i - a) % p of the
    text, p being 1 + (n - a) // (3 + g % 8).  A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.withColumns({"_ft_h": h, "_ft_words": F.when(h % 10 == 0, F.regexp_extract_all(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))})
    words, n = F.col("_ft_words"), F.size("_ft_words")
    g = F.floor(F.col("_ft_h") / 10)
    rows = rows.withColumn("_ft_a", F.when(n > 0, g % n).cast("int"))
    rows = rows.withColumn("_ft_p", (F.floor((n - F.col("_ft_a")) / (3 + g % 8)) + 1).cast("int"))
    a, p = F.col("_ft_a"), F.col("_ft_p")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    return rows.withColumn("text", F.when(a.isNotNull(), made).otherwise(F.col("text"))).select(docs.columns)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the words left."""
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), periods.found(F.col("text")).alias("f")).select("doc_id", "f.*")
    rows = rows.withColumn("top", periods.strongest(F.col("runs")))
    said = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank: ten hundredths drawn towards the benchmark texts."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; the network sees languages of four folds of five."""
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 5, 0)
    network = language.learn(docs.where(~held_out))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), language.predicted(F.col("text"), network).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_quality, op3_toxicity, op4_quality_rules, op5_top_k,
                                    op6_url_filter, op7_substring_dedup, op8_simhash, op9_line_dedup, op10_packing,
                                    op11_periodic_runs, op12_importance_resampling, op13_language_id)}


_TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_REPEATS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
late AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM windows) WHERE r > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
gone AS (SELECT DISTINCT doc_id, p + o AS i FROM late, range(0, 20) t(o)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


#: The checksum byte by byte, by its shift register, once for each distinct word.
_RESAMPLING_SQL = r"""
WITH bits AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
texts AS (
  SELECT doc_id, 0 AS target, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark),
words AS (
  SELECT doc_id, target, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
counted AS (SELECT doc_id, target, w, count(*) AS n FROM words GROUP BY ALL),
hexed AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM counted),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM hexed, bits),
placed AS (SELECT doc_id, target, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (w) GROUP BY ALL),
per AS (
  SELECT bucket, sum(n) FILTER (target = 0) AS s, sum(n) FILTER (target = 1) AS t FROM placed GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM per),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(per.t, 0) + 1)::DOUBLE * (total.s + 10000)::DOUBLE
                                 / ((coalesce(per.s, 0) + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS g
  FROM per, total),
weighed AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE target = 0 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; the others are tested by brute force."""
    return {"op5_top_k": _TOP_K_SQL, "op7_substring_dedup": _REPEATS_SQL, "op12_importance_resampling": _RESAMPLING_SQL}
