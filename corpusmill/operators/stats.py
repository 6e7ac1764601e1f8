"""Counts by url and domain, score histograms, classifier evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import percent

SCORES = (-1, 0, 1, 2, 3, 4, 5)


def count_by(df: DataFrame, *columns: Column) -> DataFrame:
    """Rows per value of the columns, and count; rows with a null or empty value are left out."""
    names = [f"_{i}" for i in range(len(columns))]
    rows = df.select(*[c.alias(n) for c, n in zip(columns, names)])
    for n in names:
        rows = rows.where(F.col(n) != "")
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("count"))


def sum_by(df: DataFrame, key: Column, count: str = "count") -> DataFrame:
    """(key, count): sums of counts per non-empty key, for rolling up and merging count tables."""
    return df.select(key.alias("key"), F.col(count).alias("n")).where(F.col("key") != "").groupBy("key").agg(F.sum("n").alias("count"))


def ratio_of_counts(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key, base_count, other_count, ratio) for keys in both tables (key, count); ratio null where other is 0."""
    joined = base.select(key, F.col("count").alias("base_count")).join(other.select(key, F.col("count").alias("other_count")), key)
    return joined.withColumn("ratio", F.round(F.try_divide(F.col("base_count").cast("double"), "other_count"), 6))


def score_distribution(df: DataFrame, score: Column, group: str | None = None) -> DataFrame:
    """(group, score, count, percent) for scores 0-5 and -1; absent scores count 0; invalid and null ones are -1.

    percent is of the valid scores, for -1 of all rows.
    """
    value = F.when(score.between(0, 5), score.cast("int")).otherwise(F.lit(-1))
    keys = [group] if group else []
    counts = df.select(*keys, value.alias("score")).groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("n"))
    # one pass over the few counts makes the fixed bins, without a join
    bins = [F.coalesce(F.sum(F.when(F.col("score") == s, F.col("n"))), F.lit(0)).alias(f"s{s}") for s in SCORES]
    wide = counts.groupBy(*keys).agg(*bins)
    valid = sum((F.col(f"s{s}") for s in SCORES[1:]), F.lit(0))
    rows = F.array(*[F.struct(F.lit(s).alias("score"), F.col(f"`s{s}`").alias("count"), percent(F.col(f"`s{s}`"), valid + F.col("`s-1`") if s < 0 else valid).alias("percent")) for s in SCORES])
    return wide.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def confusion(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """(total, tp, fp, fn, tn, precision, recall, f1, accuracy): one row.

    truth and guess are booleans; a null truth counts in total only, a null
    guess as negative. Ratios with denominator 0 are 0.
    """
    t, g = truth, F.coalesce(guess, F.lit(False))
    cells = df.select(t.alias("t"), g.alias("g")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("t") & F.col("g")).alias("tp"), F.count_if(~F.col("t") & F.col("g")).alias("fp"), F.count_if(F.col("t") & ~F.col("g")).alias("fn"), F.count_if(~F.col("t") & ~F.col("g")).alias("tn")
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)), 6)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select("*", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def precision_at_one(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """(samples, precision, recall): one row; of rows with a truth, how many have it as their top label, per guess and per truth.

    With one label a row and a guess for each both are the same; rows without a guess lower the recall only.
    """
    rows = df.select(truth.alias("t"), guess.alias("g")).where(F.col("t").isNotNull())
    right = F.count_if(F.col("t") == F.col("g"))
    ratio = lambda n: F.round(F.coalesce(F.try_divide(right.cast("double"), n), F.lit(0.0)), 6)
    return rows.agg(F.count(F.lit(1)).alias("samples"), ratio(F.count("g")).alias("precision"), ratio(F.count(F.lit(1))).alias("recall"))


def inference_report(df: DataFrame, positive: Column) -> DataFrame:
    """(total, positives, share): one row."""
    n, k = F.count(F.lit(1)), F.count_if(positive)
    return df.agg(n.alias("total"), k.alias("positives"), F.round(F.coalesce(F.try_divide(k, n), F.lit(0.0)), 6).alias("share"))
