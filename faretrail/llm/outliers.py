"""Quality rules: robust multivariate outliers among text statistics, in SQL functions only.

Per language and source, the minimum covariance determinant of transformed statistics is
approached by concentration steps: location and covariance of the share of the documents that
lies closest, from three starts, and from the best of them again and again until the determinant
of no group falls.  Documents beyond a Mahalanobis distance are rejected.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import ID, TH, original_id, staging, with_key, written

FEATURES = ("f_words", "f_length", "f_symbols", "f_lines", "f_repeats")
#: Least spread of each feature: below it, differences don't count as unusual.
FLOOR = (0.5, 0.08, 0.15, 0.15, 0.15)
#: Share of a group that the estimates rest on, and concentration steps from every start before
#: the least determinant of a group goes on alone.
SHARE, TRIED = 0.75, 2
#: Fall of a determinant's logarithm that counts.
FALL = 1e-3
#: On the covariance of the closest share, which is too small by a factor of about 1.4 for five
#: normal features: of the true covariance 18.2, the 0.997 quantile of chi-square with five
#: degrees of freedom.  The floors of spread raise it.
CUT = 25.74
#: Groups below this many documents borrow the estimates of their language, or of all.
MIN_GROUP = 60
_BLANK = r"[\x20\x09-\x0D]+"


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more; windows are compared by 64-bit hash."""
    def of_words(w: Column) -> Column:
        grams = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return _bind(F.sort_array(grams), of_sorted)

    def of_sorted(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(s, i + 1)["h"]) | x["h"].eqNullSafe(F.get(s, i - 1)["h"]))
        return _bind(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))),
                           F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_bind(words, of_words))


def base_statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text (null: none)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "measures": _bind(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"))),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": _bind(with_word, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def transformed() -> dict[str, Column]:
    """Statistics on scales where ordinary documents lie about evenly around their middle."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "f_words": F.log1p("n_words"),
        "f_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "f_symbols": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "f_lines": F.sqrt(F.col("n_dup_lines") / n),
        "f_repeats": F.sqrt(F.col("n_repeat_words") / n),
    }


def _cell(i: int, j: int) -> str:
    return f"c{min(i, j)}{max(i, j)}"


def _moments(rows: DataFrame, keys: list[str], chosen: Column) -> DataFrame:
    """Location m0.., covariance c00.. and number n of the chosen rows of each group."""
    p = range(len(FEATURES))
    own = [F.when(chosen, F.col(f)) for f in FEATURES]
    sums = [F.count(own[0]).alias("n"), *(F.avg(own[i]).alias(f"m{i}") for i in p),
            *(F.covar_pop(own[i], own[j]).alias(_cell(i, j)) for i in p for j in p if i <= j)]
    return rows.groupBy(*keys).agg(*sums)


def _factored(stats: DataFrame) -> DataFrame:
    """Adds the rows of the inverse Cholesky factor, l00.., of the covariance.

    The squared floor on the diagonal keeps it positive definite for constant features."""
    p = range(len(FEATURES))
    out = stats.withColumns({f"d{i}": F.col(_cell(i, i)) + F.lit(FLOOR[i] ** 2) for i in p})
    for j in p:  # column by column, each a projection over the ones before
        square = functools.reduce(lambda a, k: a - F.col(f"g{j}{k}") ** 2, range(j), F.col(f"d{j}"))
        out = out.withColumn(f"g{j}{j}", F.sqrt(F.greatest(square, F.lit(FLOOR[j] ** 2))))
        if below := {f"g{i}{j}": functools.reduce(lambda a, k, i=i: a - F.col(f"g{i}{k}") * F.col(f"g{j}{k}"), range(j), F.col(_cell(i, j))) / F.col(f"g{j}{j}") for i in p if i > j}:
            out = out.withColumns(below)
    return out


def _determined(stats: DataFrame) -> DataFrame:
    """:func:`_factored`, and the logarithm of the determinant."""
    return _factored(stats).withColumn("det", 2 * sum((F.log(f"g{i}{i}") for i in range(1, len(FEATURES))), F.log("g00")))


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    out = rows
    for i in range(len(FEATURES)):
        rest = functools.reduce(lambda a, k: a - F.col(f"g{i}{k}") * F.col(f"_y{k}"), range(i), F.col(FEATURES[i]) - F.col(f"m{i}"))
        out = out.withColumn(f"_y{i}", rest / F.col(f"g{i}{i}"))
    return out.withColumn("distance", sum((F.col(f"_y{i}") ** 2 for i in range(1, len(FEATURES))), F.col("_y0") ** 2))


def _joined(rows: DataFrame, keys: list[str], stats: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a group's statistics beside its rows.  Small tables are sent by Spark itself;
    else each group's estimates stand once per salt, so that no group's rows meet in one task."""
    salted = stats.select(*keys, *columns).withColumn("_ft_salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    return rows.join(written(salted, "estimates"), [*keys, "_ft_salt"])


def starts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Three estimates for each group (numbered in ``start``) from which concentration sets out.

    All use the medians for the location and the quartiles' distance for the spread of each
    feature.  0: no correlation; 1: the covariance of the hyperbolic tangents of the features in
    these units, which far values hardly move; 2: that of the directions from the median.
    """
    p = range(len(FEATURES))
    quartiles = rows.groupBy(*keys).agg(*(F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f) for f in FEATURES))
    spread = [(F.col(FEATURES[i])[2] - F.col(FEATURES[i])[0]) / 1.349 for i in p]
    plain = written(quartiles.select(*keys, *(F.col(FEATURES[i])[1].alias(f"m{i}") for i in p), *(spread[i].alias(f"s{i}") for i in p)), "quartiles")
    own = _joined(rows, keys, plain, [f"{c}{i}" for c in "ms" for i in p])
    units = [F.greatest(F.col(f"s{i}"), F.lit(FLOOR[i])) for i in p]
    own = own.withColumns({f"_z{i}": (F.col(FEATURES[i]) - F.col(f"m{i}")) / units[i] for i in p})
    own = own.withColumn("_z", F.sqrt(functools.reduce(lambda a, i: a + F.col(f"_z{i}") ** 2, p, F.lit(0.0))))
    way = [F.when(F.col("_z") > 0, F.col(f"_z{i}") / F.col("_z")).otherwise(0.0) for i in p]
    upper = [(i, j) for i in p for j in p if i <= j]
    shapes = own.groupBy(*keys).agg(
        *(F.covar_pop(F.tanh(f"_z{i}"), F.tanh(f"_z{j}")).alias(f"t{i}{j}") for i, j in upper),
        *((len(FEATURES) * F.avg(way[i] * way[j])).alias(f"w{i}{j}") for i, j in upper))
    cells = {0: lambda i, j: F.col(f"s{i}") ** 2 if i == j else F.lit(0.0),
             1: lambda i, j: F.col(f"t{i}{j}") * units[i] * units[j], 2: lambda i, j: F.col(f"w{i}{j}") * units[i] * units[j]}
    each = [F.struct(F.lit(k).alias("start"), *(of(i, j).alias(_cell(i, j)) for i, j in upper)) for k, of in cells.items()]
    return (plain.join(shapes, keys).select(*keys, *(f"m{i}" for i in p), F.explode(F.array(*each)).alias("of"))
            .select(*keys, *(f"m{i}" for i in p), "of.*"))


def _concentrated(rows: DataFrame, keys: list[str], now: DataFrame) -> DataFrame:
    """One step for each of the estimates ``now`` (``keys`` tell them apart): location and
    covariance of the share of the rows that lies closest."""
    p = range(len(FEATURES))
    shared = [k for k in keys if k in rows.columns]
    beside = [*(k for k in keys if k not in shared), *(f"m{i}" for i in p), *(f"g{i}{j}" for i in p for j in p if j <= i)]
    near = _distance(_joined(rows, shared, now, beside)).select(*keys, "_ft_salt", *FEATURES, "distance")
    # the share's edge: quantile of the distances, summed up in bounded sketches
    edge = near.groupBy(*keys).agg(F.percentile_approx("distance", SHARE, 1000).alias("edge"))
    near = _joined(near, keys, edge, ["edge"])
    return written(_determined(_moments(near, keys, F.col("distance") <= F.col("edge"))), "estimates")


def estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Location and factor for each group of ``rows`` (a written table), by :data:`TRIED` steps
    from each of the :func:`starts`, and from the least determinant found so on until it no
    longer falls.  Groups that stand leave the loop; it ends, as each step takes :data:`FALL` off
    a logarithm that the floors bound from below.

    Quantiles are sketches, whose merging follows the order in which tasks end: a distance that
    equals the cut to several digits may be judged otherwise by another run.
    """
    now = written(_determined(starts(rows, keys)), "estimates")
    for _ in range(TRIED):
        now = _concentrated(rows, [*keys, "start"], now)
    fields = [c for c in now.columns if c not in (*keys, "start")]
    now = written(now.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.struct("det", "start")).alias("s")).select(*keys, "s.*"), "estimates")
    standing = []
    while True:
        after = _concentrated(rows, keys, now)
        old, new = (t.select(*keys, F.struct(*fields).alias(c)) for t, c in ((now, "old"), (after, "new")))
        both = written(old.join(new, keys).select(
            *keys, (F.col("old.det") - F.col("new.det") > FALL).alias("falls"),
            F.when(F.col("new.det") < F.col("old.det"), F.col("new")).otherwise(F.col("old")).alias("s")), "estimates")
        standing.append(both.where("NOT falls").select(*keys, "s.*"))
        now = both.where("falls").select(*keys, "s.*")
        if now.isEmpty():
            return written(functools.reduce(DataFrame.unionByName, standing), "estimates")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", cut: float = CUT) -> DataFrame:
    """doc_id, n_words, the base statistics, base_failed, distance, kept for every row.

    A document fails the base rule below 50 words or if over half its words stand in repeated
    3-word windows; those don't enter the estimates.  Null and empty texts have no words and
    fail; null languages and sources are groups of their own; equal rows are judged alike.
    """
    base = base_statistics(F.col(text_col))
    rows = (with_key(docs, id_col, text_col)
            .select(ID, F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")).alias("lang"),
                    F.coalesce(F.col(source_col).cast("string"), F.lit("\0")).alias("source"), TH, *(c.alias(k) for k, c in base.items()))
            .select(ID, "lang", "source", TH, "measures.*", "n_symbols", "n_dup_lines"))
    rows = rows.withColumns(transformed()).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    with staging() as keep:
        rows = written(rows.withColumn("_ft_salt", F.pmod(F.xxhash64(ID, TH), F.lit(32)).cast("int")), "statistics")
        sound = rows.where(~F.col("base_failed")).select("lang", "source", "_ft_salt", *FEATURES)
        sizes = written(sound.groupBy("lang", "source").agg(F.count("*").alias("n")), "sizes")
        by_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
        # which estimates a group goes by: its own, its language's or those of all
        level = sizes.join(by_lang, "lang").select(
            "lang", "source", F.when(F.col("n") >= MIN_GROUP, F.concat_ws("\1", "lang", "source"))
            .when(F.col("n_lang") >= MIN_GROUP, F.col("lang")).otherwise(F.lit("")).alias("group"))
        level = written(level.withColumn("_ft_salt", F.explode(F.sequence(F.lit(0), F.lit(31)))), "levels")
        named = sound.join(level, ["lang", "source", "_ft_salt"])
        borrowed = level.where(~F.col("group").contains("\1")).select("group").distinct()
        wide = sound.select(F.explode(F.array(F.col("lang"), F.lit(""))).alias("group"), "_ft_salt", *FEATURES).join(borrowed, "group")
        fitted = written(named.where(F.col("group").contains("\1")).select("group", "_ft_salt", *FEATURES).unionByName(wide), "fitted")
        of = estimates(fitted, ["group"])
        placed = rows.join(level, ["lang", "source", "_ft_salt"], "left").withColumn("group", F.coalesce("group", F.lit("")))
        p = range(len(FEATURES))
        salted = written(of.select("group", *(f"m{i}" for i in p), *(f"g{i}{j}" for i in p for j in p if j <= i))
                         .withColumn("_ft_salt", F.explode(F.sequence(F.lit(0), F.lit(31)))), "final")
        keep(rows, level, salted)
    out = _distance(placed.join(salted, ["group", "_ft_salt"], "left"))
    return out.select(original_id().alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.when(~F.col("base_failed"), F.col("distance")).alias("distance"),
                      (~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))).alias("kept"))
