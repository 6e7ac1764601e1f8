"""Lines that one site sets into many of its documents.

Copies of a document are collapsed to a cluster (equal site and text) before
lines are counted, so each line has three counts: documents, clusters of
distinct documents, and publication dates. Only 64-bit hashes of lines are
shuffled, never texts. Counting runs per (line, cluster) first, so a line that
stands in a third of all documents is spread over tasks; the join back to the
places of the lines is salted for the same reason.

Which lines count as boilerplate is a matter of the least documents, clusters
and dates. An article that a site publishes many times is many documents, but
one cluster: with a minimum of clusters its lines stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import materialize

#: Documents of a site in which a line must occur.
MIN_DOCS = 5
#: Copies of each line's key in the join with the places of lines.
SALTS = 8


def normal_lines(text: Column) -> Column:
    """The lines of text (cut at LF, blank ones included) in their compared form.

    Lower case, white space trimmed and collapsed, each run of digits one 0.
    """
    squeezed = F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[\s&&[^\n]]+", " "), "[0-9]+", "0")
    return F.transform(F.split(squeezed, "\n", -1), lambda line: F.trim(line))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("text").isNotNull() & F.col("site").isNotNull()).select(
        "doc_id", "site", "day", F.xxhash64("text", F.length("text")).alias("cluster"), normal_lines(F.col("text")).alias("lines")
    )


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, k1, k2, cluster, day): the non-blank lines of docs (doc_id, site, day, text), as a table.

    k1 and k2 are a 128-bit key of site and compared line. Rows with null text
    or site take no part. The table is read twice, by the count and for the places.
    """
    each = _lines(docs).select("doc_id", "site", "cluster", "day", F.posexplode("lines").alias("line_no", "line")).where(F.col("line") != "")
    keys = F.xxhash64("site", "line").alias("k1"), F.xxhash64("line", "site", F.lit("second")).alias("k2")
    return materialize(each.select("doc_id", F.col("line_no").cast("long").alias("line_no"), *keys, "cluster", "day"), "lines")


def repeated_lines(keyed: DataFrame, min_docs: int = MIN_DOCS, min_clusters: int = 1, min_days: int = 0) -> DataFrame:
    """(k1, k2, docs, clusters, days): the keyed lines that at least so many documents, clusters and dates of their site hold.

    A document counts once for a line however often it holds it; a null day
    counts as no date.
    """
    once = keyed.groupBy("k1", "k2", "cluster", "day").agg(F.count_distinct("doc_id").alias("docs"))
    found = once.groupBy("k1", "k2").agg(F.sum("docs").alias("docs"), F.count_distinct("cluster").alias("clusters"), F.count_distinct("day").alias("days"))
    # only what is asked of the last two counts is computed
    for column, least, always in (("docs", min_docs, 1), ("clusters", min_clusters, 1), ("days", min_days, 0)):
        if least > always:
            found = found.where(F.col(column) >= least)
    return found


def places(keyed: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, line_no): where the given lines (k1, k2) stand, numbered from 0 with blank lines included."""
    at = keyed.select("doc_id", "line_no", "k1", "k2", F.pmod("doc_id", F.lit(SALTS)).cast("int").alias("salt"))
    salted = lines.select("k1", "k2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return at.join(salted, ["k1", "k2", "salt"], "left_semi").select("doc_id", "line_no")


def boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, min_clusters: int = 1, min_days: int = 0) -> DataFrame:
    """(doc_id, line_no): every line that at least so many documents, clusters and dates of its site hold."""
    keyed = keyed_lines(docs)
    return places(keyed, repeated_lines(keyed, min_docs, min_clusters, min_days).select("k1", "k2"))


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(site, line, docs, clusters, days): the repeated lines in their compared form, with their counts.

    Each line's words are read from the one document that holds it first.
    """
    keyed = keyed_lines(docs)
    lines = repeated_lines(keyed, min_docs)
    # at most one row per line and map task reaches the shuffle
    first = keyed.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "line_no")).alias("at")).join(lines, ["k1", "k2"]).select("at.*", "docs", "clusters", "days")
    shown = _lines(docs).select("doc_id", "site", "lines").join(first, "doc_id")
    return shown.select("site", F.get("lines", F.col("line_no").cast("int")).alias("line"), "docs", "clusters", "days")


def marked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with drop, the sorted numbers of their lines found: (doc_id, line_no); null without any."""
    numbers = found.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.col("line_no").cast("int"))).alias("drop"))
    return docs.join(numbers, "doc_id", "left")


def without_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with text cleaned of the lines found: (doc_id, line_no); rows and other columns stay.

    A column named drop is not kept. Linear in a document's lines: they are
    split before the join, so that no step splits them again for each line.
    """
    split = docs.drop("drop").withColumn("text", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("text") - 1), F.coalesce("drop", F.array().cast("array<int>")))
    text = F.when(F.col("text").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get("text", i)), "\n"))
    return marked(split, found).withColumn("text", text).drop("drop")
