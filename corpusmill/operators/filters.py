"""Row filters on length, score, probability, domain and label. A null in the tested column drops the row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as txt
from corpusmill.functions import urls

MIN_CHARS, MAX_CHARS, LONG_CHARS = 20, 100_000, 6_000


def length_filter(df: DataFrame, column: str = "text", low: int = MIN_CHARS, high: int = MAX_CHARS, strict: bool = False) -> DataFrame:
    """Rows whose text has low to high characters; strict excludes both bounds."""
    n = F.length(column)
    return df.where((n > low) & (n < high) if strict else n.between(low, high))


def long_text(df: DataFrame, column: str = "text", low: int = LONG_CHARS) -> DataFrame:
    """Distinct texts of at least low characters within the length filter; only the text column.

    The texts themselves are the result, so each distinct one is shuffled once, after map-side combining.
    """
    return length_filter(df, column).where(F.length(column) >= low).select(column).distinct()


def score_filter(df: DataFrame, score: str, columns: list[str], low: float | None = None, high: float | None = None, text: str = "text") -> DataFrame:
    """Rows within the length filter whose score, coerced to a number, lies in [low, high]; distinct on (score, columns).

    A bound of None is off. The same text with two scores stays twice.
    """
    rows = length_filter(df, text).withColumn(score, txt.numeric(F.col(score))).where(F.col(score).isNotNull())
    if high is not None:
        rows = rows.where(F.col(score) <= high)
    if low is not None:
        rows = rows.where(F.col(score) >= low)
    return rows.select(score, *columns).distinct()


def prob_filter(df: DataFrame, prob: str = "prob", low: float = 0.9) -> DataFrame:
    """Rows with a probability of at least low (NaN is none)."""
    return df.where(~F.isnan(prob) & (F.col(prob) >= low))


def kept_share(df: DataFrame, kept: Column) -> DataFrame:
    """(total, kept, ratio): one row; ratio 0 for an empty table."""
    n, k = F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(kept, F.lit(False)).cast("long")), F.lit(0))
    return df.agg(n.alias("total"), k.alias("kept"), F.round(F.coalesce(F.try_divide(k, n), F.lit(0.0)), 6).alias("ratio"))


def positive_filter(df: DataFrame, label: str = "label", prob: str = "prob", positive: str = "__label__1", above: float = 0.9) -> DataFrame:
    """Rows whose top label is the positive one with a probability strictly above the bound."""
    return df.where((F.col(label) == positive) & ~F.isnan(prob) & (F.col(prob) > above))


def domain_filter(df: DataFrame, domain: Column, allowed: DataFrame) -> DataFrame:
    """Rows whose domain stands in allowed (domain). The planner broadcasts the list only if it is small."""
    return df.withColumn("_domain", domain).join(allowed.select(F.col("domain").alias("_domain")).distinct(), "_domain", "left_semi").drop("_domain")


def language_filter(df: DataFrame, language: Column, languages: list[str], score: Column | None = None, least: float = 0.65) -> DataFrame:
    """Rows whose language, before '-' and case aside, is one of languages, with a score of at least least if score is given."""
    kept = df.where(F.lower(F.substring_index(language, "-", 1)).isin(languages))
    return kept if score is None else kept.where(~F.isnan(score) & (score >= least))


def url_filter(df: DataFrame, url: Column, hosts: DataFrame, words: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose url's host, and no domain above it, stands in hosts (host), and whose url holds none of the words, case aside.

    Null urls stay. The planner broadcasts the hosts only if they are few.
    """
    parts = F.split(urls.host(url), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    keyed = df.withColumn("_url_row", F.monotonically_increasing_id())
    names = keyed.select("_url_row", F.explode(above).alias("host")).join(hosts.select(F.lower("host").alias("host")).distinct(), "host", "left_semi")
    out = keyed.join(names.select("_url_row").distinct(), "_url_row", "left_anti").drop("_url_row")
    for word in words:
        out = out.where(~F.coalesce(F.contains(F.lower(url), F.lit(word.lower())), F.lit(False)))
    return out


def rescore_candidates(df: DataFrame, score: str, low: int = 0, high: int = 5) -> DataFrame:
    """Rows that need a (new) score: none, not a number, or outside [low, high]."""
    value = txt.numeric(F.col(score))
    return df.where(value.isNull() | (value < low) | (value > high))


def first_failing(stages: list[tuple[str, Column]]) -> Column:
    """Name of the first stage whose failure condition holds; null if none does (null conditions don't)."""
    tests = [F.when(F.coalesce(failed, F.lit(False)), F.lit(name)) for name, failed in stages]
    return reduce(lambda a, b: F.coalesce(a, b), tests)
