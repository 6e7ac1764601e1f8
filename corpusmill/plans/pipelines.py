"""The corpus pipelines end to end: read, filter, deduplicate, classify, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import hashing, urls
from corpusmill.operators import classifier, dedup, filters, language, minhash, quality, sampling, stats
from corpusmill.scratch import materialize
from corpusmill.sources import readers, writers

WEB_RECORD = "warc_record_id string, url string, text string"


@dataclass
class CorpusOptions:
    """Settings of the corpus pipeline."""

    languages: tuple[str, ...] = ("en",)
    #: folder: near-duplicates are looked for within each sub-folder; global: over all.
    scope: str = "folder"
    glob: str = "*.jsonl*"


def curate(docs: DataFrame, options: CorpusOptions | None = None) -> DataFrame:
    """docs (doc_id unique, folder, text) with rewritten text and reject_stage, null for what is kept.

    Stages: the quality cascade with a guessed language, then near-duplicates
    among its survivors (stage minhash).
    """
    options = options or CorpusOptions()
    told = language.with_language(docs)
    staged = quality.cascade(told, F.col("language"), list(options.languages))
    staged = materialize(staged.join(docs.select("doc_id", "folder"), "doc_id"), "cascade")
    kept = staged.where(F.col("reject_stage").isNull()).select("doc_id", "folder", "text")
    # a folder's classes are made of its own documents only
    scope = F.col("folder") if options.scope == "folder" else None
    removed = minhash.near_duplicates(kept, short_copies=True, scope=scope).where("doc_id <> class_id").select("doc_id")
    marked = removed.withColumn("again", F.lit("minhash"))
    return staged.join(marked, "doc_id", "left").select("doc_id", "folder", "text", F.coalesce("reject_stage", "again").alias("reject_stage"))


def run_corpus(spark: SparkSession, source: str, target: str, options: CorpusOptions | None = None) -> DataFrame:
    """Curate the web records below source; kept texts go to target/kept, rejects to target/removed by folder and stage.

    Returns (reject_stage, docs), with 'kept' for survivors.
    """
    options = options or CorpusOptions()
    scan = spark.read.schema(WEB_RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", options.glob).json(source)
    rows = readers.with_folder(scan, source)
    numbered = materialize(rows.select("folder", "warc_record_id", "url", "text").withColumn("doc_id", F.monotonically_increasing_id()), "records")
    done = materialize(curate(numbered, options), "curated")
    kept = done.where(F.col("reject_stage").isNull()).drop("reject_stage").join(numbered.select("doc_id", "warc_record_id", "url"), "doc_id").drop("doc_id")
    writers.write_rejects(kept, f"{target}/kept", "folder")
    writers.write_rejects(done.where(F.col("reject_stage").isNotNull()).drop("doc_id"), f"{target}/removed", "folder", "reject_stage")
    return done.groupBy(F.coalesce("reject_stage", F.lit("kept")).alias("reject_stage")).agg(F.count(F.lit(1)).alias("docs"))


def run_dedup(rows: DataFrame, target: str, order: str, columns: tuple[str, ...] = ("url", "text"), known: DataFrame | None = None, shard_rows: int = 100_000, as_files: bool = False) -> DataFrame:
    """Write the records with unseen keys to rolling shards below target; returns their keys for the next run.

    Keys are of the given columns; order (unique) decides which of equal
    records is the first. Shards are folders of a table partitioned by folder
    and shard, or with as_files the files of writers.write_shards.
    """
    fresh = dedup.new_records(rows, hashing.row_sha(*map(F.col, columns)), order, known)
    if as_files:
        fresh = materialize(fresh, "fresh")
        writers.write_shards(fresh.drop("record_key"), target, shard_rows, order)
        return fresh.select("record_key")
    placed = writers.with_position(fresh, order)
    shard = writers.shard_path(F.col("position"), shard_rows, "")
    placed = placed.withColumn("folder", F.substring_index(shard, "/", 1)).withColumn("shard", F.substring_index(shard, "/", -1))
    placed.drop("position", "record_key").write.partitionBy("folder", "shard").option("compression", "gzip").json(target)
    return placed.select("record_key")


def run_classifier(positive: DataFrame, negative: DataFrame, corpus: DataFrame, above: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(kept rows of corpus, evaluation on the held-out fifth) of a classifier trained on positive and negative texts."""
    labelled = classifier.training_set(positive, negative)
    split = materialize(sampling.train_val_split(labelled, F.col("label"), F.col("text")), "split")
    model = classifier.train(split.where("split = 'train'"))
    held_out = classifier.predict(split.where("split = 'val'").withColumnRenamed("label", "truth"), model)
    evaluation = stats.confusion(held_out, F.col("truth") == 1, F.col("label") == "__label__1")
    return classifier.predict(corpus, model).where(classifier.is_positive(above=above)), evaluation


def domain_corpus(corpus: DataFrame, allowed: DataFrame, domain: Column | None = None) -> DataFrame:
    """Rows within the length filter whose host stands in allowed (domain), once per text."""
    host = urls.fqdn(F.col("url")) if domain is None else domain
    return filters.domain_filter(filters.length_filter(corpus), host, allowed).dropDuplicates(["text"])


def dedup_csv(spark: SparkSession, source: str | list[str], schema: str, target: str, keys: list[str], low: int | None = None, high: int | None = None, text: str = "text") -> DataFrame:
    """Write the rows of CSV files below source once per key to target; returns (total, duplicated, remain).

    Of equal keys the row that stands first in the order of file names and
    offsets stays. With bounds, only rows whose text is longer than low and
    shorter than high count.
    """
    rows = readers.read_csv(spark, source, T.StructType.fromDDL(schema), recursive=True)
    if low is not None or high is not None:
        n = F.length(text)
        rows = rows.where((n > (low if low is not None else -1)) & (n < (high if high is not None else 1 << 31)))
    numbered = materialize(rows.select("*", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("_at")), "csv-rows")
    writers.write(dedup.keep_first(numbered, keys, "_at").drop("_at"), target, "csv")
    return dedup.dedup_metrics(numbered, keys)


def merge_csv(spark: SparkSession, source: str, schema: str, target: str, distinct: bool = False) -> DataFrame:
    """Write all CSV files at any depth below source as one table to target; returns (files, rows) as read.

    The files keep to one schema, as the merged table does; with distinct each row is written once.
    """
    rows = readers.read_csv(spark, source, T.StructType.fromDDL(schema), recursive=True)
    writers.write(dedup.dedup_rows(rows) if distinct else rows, target, "csv")
    return rows.select(F.col("_metadata.file_path").alias("file")).agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows"))
