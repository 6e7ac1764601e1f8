"""Score cutoffs per source that keep a target fraction of its records.

Within each source the records are ordered by score and identifier, the exact
cumulative position is computed, and the score at the target count is the
cutoff. A source with a third of all rows is not sorted in one task: equal
scores are combined before the shuffle, scores fall into ordered buckets, the
position before each bucket comes from the (at most BUCKETS) bucket counts of
the source. The bucket with the cutoff is cut into buckets again, LEVELS times
in all, so that scores crowded near one value part as well, and only what lies
in one of its last buckets is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.scratch import materialize

#: Ordered score buckets of a source, also the largest group of the bucket counts, and how often a bucket is cut again:
#: the last ones are 1e-14 wide.
BUCKETS, LEVELS = 4096, 4
#: Highest valid score.
TOP = 1.0001
#: Copies of a source's cutoff, so that one source's records spread over tasks.
SALTS = 16


def valid_records(df: DataFrame, record_id: Column, source: Column, score: Column) -> DataFrame:
    """(rec, source, score) of the valid records, each once.

    Valid: score not null, not NaN and from 0 to TOP. Exact repeats of a
    record count once. A null or missing source becomes '' and takes the
    default target.
    """
    score = score.cast("double")
    return (
        df.select(record_id.alias("rec"), F.coalesce(source, F.lit("")).alias("source"), score.alias("score"))
        .where(F.col("rec").isNotNull() & ~F.isnan("score") & F.col("score").between(0.0, TOP))
        .distinct()
    )


def cutoffs(valid: DataFrame, targets: DataFrame, default: str = "*") -> DataFrame:
    """(source, n, target, cutoff, kept): the cutoff of each source with valid records.

    targets: (source, keep_pct), one row per source; the row ``default`` holds
    for all others, and a source without any target keeps nothing. target =
    ceil(keep_pct * n / 100); cutoff is the highest score that keeps at least
    so many records (ties at the cutoff are all kept), null if target is 0.
    A keep_pct above 100 keeps all, a negative one nothing; a null one counts as
    not listed.
    """
    counted = valid.groupBy("source", "score").agg(F.count(F.lit(1)).alias("c"))
    place = F.col("score") / TOP
    for level in range(LEVELS):  # b0, b1, ...: the bucket, the bucket in the bucket, and so on
        bucket = F.least(F.floor(place * BUCKETS), F.lit(BUCKETS - 1))
        counted, place = counted.withColumn(f"b{level}", bucket), place * BUCKETS - bucket
    scores = materialize(counted.withColumn("salt", _salt("score")), "scores")
    buckets = scores.groupBy("source", "b0").agg(F.sum("c").alias("in_bucket"))
    # each source looks for its own target first, then for the default one
    sizes = buckets.groupBy("source").agg(F.sum("in_bucket").alias("n"))
    wanted = sizes.select("source", "n", F.posexplode(F.array_distinct(F.array("source", F.lit(default)))).alias("rank", "key"))
    named = targets.select(F.col("source").alias("key"), "keep_pct")
    aimed = wanted.join(named, "key", "left").groupBy("source", "n").agg(F.min_by("keep_pct", F.when(F.col("keep_pct").isNotNull(), F.col("rank"))).alias("pct"))
    pct = F.greatest(F.least(F.coalesce("pct", F.lit(0)), F.lit(100)), F.lit(0))
    aimed = materialize(aimed.select("source", "n", F.floor((pct * F.col("n") + 99) / 100).alias("target")), "targets")
    critical = _critical(buckets.join(aimed.where("target > 0").withColumn("before", F.lit(0).cast("long")), "source"), "b0")
    for level in range(1, LEVELS):
        inner = _inside(scores, critical, level).groupBy("source", "n", "target", "before", *_path(level + 1)).agg(F.sum("c").alias("in_bucket"))
        critical = _critical(inner, f"b{level}")
    last = Window.partitionBy("source").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    position = (
        _inside(scores, critical, LEVELS)
        .withColumn("position", F.col("before") + F.sum("c").over(last))
        .where((F.col("position") >= F.col("target")) & (F.col("position") - F.col("c") < F.col("target")))
        .select("source", "n", "target", F.col("score").alias("cutoff"), F.col("position").alias("kept"))
    )
    none = aimed.where(F.col("target") == 0).select("source", "n", "target", F.lit(None).cast("double").alias("cutoff"), F.lit(0).cast("long").alias("kept"))
    return position.unionByName(none)


def _path(levels: int) -> list[str]:
    return [f"b{k}" for k in range(levels)]


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int").alias("salt")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _critical(buckets: DataFrame, bucket: str) -> DataFrame:
    """The bucket of each source in which its target lies, with the records before it in place of before and in_bucket."""
    downwards = Window.partitionBy("source").orderBy(F.desc(bucket)).rowsBetween(Window.unboundedPreceding, 0)  # at most BUCKETS rows
    upto = buckets.withColumn("upto", F.col("before") + F.sum("in_bucket").over(downwards))
    here = upto.where((F.col("upto") >= F.col("target")) & (F.col("upto") - F.col("in_bucket") < F.col("target")))
    return here.withColumn("before", F.col("upto") - F.col("in_bucket")).drop("upto", "in_bucket")


def _inside(scores: DataFrame, critical: DataFrame, levels: int) -> DataFrame:
    """The scores in the critical bucket of their source, a source's rows spread by salt."""
    return scores.join(_salted(critical), ["source", "salt", *_path(levels)]).drop("salt")


def kept_records(valid: DataFrame, cuts: DataFrame) -> DataFrame:
    """(rec, source, score) of the records at or above their source's cutoff."""
    salted = _salted(cuts.where(F.col("cutoff").isNotNull()).select("source", "cutoff"))
    return valid.withColumn("salt", _salt("rec")).join(salted, ["source", "salt"]).where(F.col("score") >= F.col("cutoff")).select("rec", "source", "score")
