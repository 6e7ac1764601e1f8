"""Queries of the core operators over the tables of a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import hashing, labels, text, urls
from corpusmill.operators import classifier, components, dedup, filters, judge, language, masking, minhash, quality, registry, sampling, segment, stats
from corpusmill.plans import pipelines
from corpusmill.scratch import shared_dir
from corpusmill.sources import readers, writers
from corpusmill.sources.tables import load, load_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SEED = 42
FILE_ROWS, SHARD_ROWS = 150, 40


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return load_texts(spark, d, "documents")


def _of_docs(name: str, expression: Callable[[], Column]) -> None:
    """A query (doc_id, value) of one expression over documents."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _docs(spark, d).select("doc_id", expression().alias("value"))

    run.__name__, run.__doc__ = name, f"(doc_id, value): {name} of every document."
    QUERIES[name] = run


_of_docs("clean_text", lambda: text.clean_text(F.col("text")))
_of_docs("clean_whitespace", lambda: text.clean_whitespace(F.col("text")))
_of_docs("flatten_newlines", lambda: text.flatten_newlines(F.col("text")))
_of_docs("clean_filename", lambda: text.clean_filename(F.col("url")))
_of_docs("truncate_text", lambda: text.truncate_text(F.col("text"), 500))
_of_docs("word_count", lambda: text.word_count(F.col("text")))
_of_docs("dedup_hash_md5", lambda: hashing.row_md5(F.col("url"), F.col("text")))
_of_docs("dedup_hash_sha", lambda: hashing.row_sha(F.col("url"), F.col("text")))
_of_docs("label_lines", lambda: labels.label_line(F.lit(1), F.col("text")))
_of_docs("fqdn", lambda: urls.fqdn(F.col("url")))
_of_docs("mask_addresses", lambda: masking.mask_addresses(F.col("text")))
_of_docs("token_count", lambda: masking.token_count(F.col("text")))
_of_docs("guess_format", lambda: readers.format_of(F.col("url")))
_of_docs("html_text", lambda: masking.html_text(F.col("text")))


@query
def minimum_slice(spark, d):
    """Documents by language after length filter, cleaning and dedup."""
    rows = filters.length_filter(_docs(spark, d)).select("lang", text.clean_text(F.col("text")).alias("clean")).where("clean <> ''")
    once = rows.select("lang", dedup.digest(F.col("clean")).alias("digest")).distinct()
    return once.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))


# --- sources and sinks ---


def _table_of_docs(spark, d):
    return _docs(spark, d).select("doc_id", "url", "text", "lang")


def _fresh(spark, name: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def scan_roundtrip_csv(spark, d):
    """Documents written as CSV and read again; texts span lines and hold quotes."""
    df, path = _table_of_docs(spark, d).where("text is not null and text <> ''"), _fresh(spark, "csv")
    writers.write(df, path, "csv")
    return readers.read_csv(spark, path, df.schema).select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query
def scan_roundtrip_jsonl(spark, d):
    """Documents written as gzip JSON lines and read again."""
    df, path = _table_of_docs(spark, d), _fresh(spark, "jsonl")
    writers.write(df, path, "jsonl", compression="gzip")
    return readers.read_jsonl(spark, path, df.schema)


@query
def scan_roundtrip_zst(spark, d):
    """Documents written as .jsonl.zst files and read again."""
    df, path = _table_of_docs(spark, d), _fresh(spark, "zst")
    writers.write(df, path, "jsonl", compression="zstd")
    return readers.read_jsonl(spark, path, df.schema, glob="*.jsonl.zst")


@query
def scan_bad_json(spark, d):
    """(good, bad): rows read and bad lines set aside from JSON lines of which every tenth is cut short."""
    path = _fresh(spark, "bad-json")
    line = F.to_json(F.struct("doc_id", "lang"))
    _docs(spark, d).select(F.when(F.col("doc_id") % 10 == 0, F.substring(line, 1, 8)).otherwise(line).alias("value")).write.text(path)
    good, bad = readers.read_jsonl_tolerant(spark, path, T.StructType.fromDDL("doc_id long, lang string"))
    return good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query
def scan_bad_rows(spark, d):
    """(doc_id): rows of a CSV that survive when every tenth has a bad number."""
    path = _fresh(spark, "bad-csv")
    number = F.when(F.col("doc_id") % 10 == 0, F.lit("x")).otherwise(F.col("doc_id").cast("string"))
    _docs(spark, d).select(number.alias("doc_id"), "source").write.csv(path, header=True)
    return readers.read_csv(spark, path, "doc_id long, source string", tolerant=True).select("doc_id")


@query
def scan_bad_rows_rejected(spark, d):
    """(kind, rows): rows and rejects of the same CSV read tolerantly with observable rejects."""
    path = _fresh(spark, "bad-csv")
    number = F.when(F.col("doc_id") % 10 == 0, F.lit("x")).otherwise(F.col("doc_id").cast("string"))
    _docs(spark, d).select(number.alias("doc_id"), "source").write.csv(path, header=True)
    good, bad = readers.read_csv_tolerant(spark, path, T.StructType.fromDDL("doc_id long, source string"), multi_line=False)
    kinds = good.select("doc_id", F.lit("good").alias("kind")).unionByName(bad.select(F.lit(None).cast("long").alias("doc_id"), F.lit("bad").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@query
def scan_json_array(spark, d):
    """(item_id, task): benchmark items written as one JSON array and read again."""
    path = _fresh(spark, "items-array")
    items = load(spark, d, "benchmark").select("item_id", "task")  # a fixed small table
    items.agg(F.to_json(F.collect_list(F.struct("item_id", "task"))).alias("value")).coalesce(1).write.text(path)
    return readers.read_json_array(spark, path, T.StructType.fromDDL("item_id long, task string"))


@query
def unprocessed_files(spark, d):
    """(path): sites as files of which those of the filtered corpus's manifest are done."""
    files = _docs(spark, d).select(F.col("source").alias("path")).where("path is not null").distinct()
    manifest = _fresh(spark, "manifest")
    load(spark, d, "filtered_corpus").select(F.try_element_at("metadata", F.lit("source")).alias("path")).where("path is not null").distinct().write.parquet(manifest)
    return readers.unprocessed(spark, files, manifest)


@query
def label_line_roundtrip(spark, d):
    """(ok, label, lines, chars): label lines written as text, read and parsed."""
    path = _fresh(spark, "labels")
    writers.write_label_lines(_docs(spark, d).select((F.col("doc_id") % 2).alias("label"), "text"), path)
    parsed = readers.parse_label_lines(spark.read.text(path))
    return parsed.groupBy("ok", "label").agg(F.count(F.lit(1)).alias("lines"))


@query
def parse_label_lines(spark, d):
    """(label, text, ok) of lines made from the documents, good and bad."""
    line = F.when(F.col("doc_id") % 7 == 0, F.lit("x y")).when(F.col("doc_id") % 11 == 0, F.lit("__label__0")).otherwise(F.concat(F.lit("__label__1 "), F.col("source"), F.lit(" "), F.col("lang")))
    return readers.parse_label_lines(_docs(spark, d).select(line.alias("value")))


@query
def file_chunk_assign(spark, d):
    """(doc_id, file_no): numbered files of FILE_ROWS rows in order of doc_id."""
    return writers.with_position(_docs(spark, d).select("doc_id"), "doc_id").select("doc_id", writers.file_number(F.col("position"), FILE_ROWS).alias("file_no"))


@query
def shard_assign(spark, d):
    """(doc_id, shard): rolling shards of SHARD_ROWS rows in order of doc_id."""
    return writers.with_position(_docs(spark, d).select("doc_id"), "doc_id").select("doc_id", writers.shard_path(F.col("position"), SHARD_ROWS).alias("shard"))


@query
def chunk_assign(spark, d):
    """(event_id, chunk): chunks of 1000 events in order of event_id."""
    return writers.with_position(load(spark, d, "events").select("event_id"), "event_id").select("event_id", writers.file_number(F.col("position"), 1000).alias("chunk"))


@query
def even_split(spark, d):
    """(item_id, part): the items in 7 parts of sizes that differ by at most one."""
    items = load(spark, d, "benchmark").select("item_id")
    return writers.with_position(items, "item_id").select("item_id", writers.even_part(F.col("position"), items.count(), 7).alias("part"))


@query
def reject_sink(spark, d):
    """(reject_stage, rows): rejects written by stage and read again."""
    path = _fresh(spark, "rejects")
    writers.write_rejects(filter_cascade(spark, d).where("reject_stage is not null"), path, "reject_stage")
    return spark.read.schema("doc_id long, reject_stage string").json(path).groupBy("reject_stage").agg(F.count(F.lit(1)).alias("rows"))


@query
def discovered_folders(spark, d):
    """(folder, rows): rows by sub-folder of a corpus written by language."""
    path = _fresh(spark, "corpus")
    _docs(spark, d).select("doc_id", F.coalesce(F.lower("lang"), F.lit("none")).alias("l")).where("l <> ''").write.partitionBy("l").parquet(path)
    return readers.with_folder(spark.read.option("recursiveFileLookup", "true").schema("doc_id long").parquet(path), path).groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))


# --- filters ---


@query
def len_filter(spark, d):
    """(doc_id): texts of 20 to 100,000 characters."""
    return filters.length_filter(_docs(spark, d)).select("doc_id")


@query
def len_filter_strict(spark, d):
    """(doc_id): texts of more than 20 and fewer than 100,000 characters."""
    return filters.length_filter(_docs(spark, d), strict=True).select("doc_id")


@query
def language_filter(spark, d):
    """(doc_id): documents declared English."""
    return filters.language_filter(_docs(spark, d), F.col("lang"), ["en"]).select("doc_id")


@query
def long_text(spark, d):
    """(text): distinct long texts."""
    return filters.long_text(_docs(spark, d), low=3000)


@query
def score_filter(spark, d):
    """(prob, text, url): predictions with a score in [0.2, 0.9], distinct."""
    return filters.score_filter(load(spark, d, "predictions"), "prob", ["text", "url"], 0.2, 0.9)


@query
def prob_filter(spark, d):
    """(pred_id): predictions of at least 0.9."""
    return filters.prob_filter(load(spark, d, "predictions")).select("pred_id")


@query
def prob_filter_stats(spark, d):
    """(total, kept, ratio) of the probability threshold."""
    return filters.kept_share(load(spark, d, "predictions"), ~F.isnan("prob") & (F.col("prob") >= 0.9))


@query
def positive_filter(spark, d):
    """(pred_id): predictions of the positive label above 0.9."""
    return filters.positive_filter(_predicted(spark, d)).select("pred_id")


def _predicted(spark, d):
    """Predictions with the label that their probability stands for."""
    valid = ~F.isnan("prob") & F.col("prob").between(0, 1)
    rows = load(spark, d, "predictions").where(valid)
    return rows.withColumn("label", F.when(F.col("prob") >= 0.5, "__label__1").otherwise("__label__0")).withColumn("prob", F.greatest("prob", 1 - F.col("prob")))


@query
def pos_neg_split(spark, d):
    """(label, n): predictions by stripped label."""
    return _predicted(spark, d).groupBy(labels.strip_label(F.col("label")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query
def pos_neg_outputs(spark, d):
    """(side, rows): predictions written as a positive and a negative output and read again."""
    path = _fresh(spark, "sides")
    writers.write_by_label(_predicted(spark, d).select("pred_id", "label", "prob"), path, classifier.is_positive())
    sides = [spark.read.schema("pred_id long").json(f"{path}/{side}").select(F.lit(side).alias("side")) for side in ("positive", "negative")]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


@query
def url_filter(spark, d):
    """(record_id): crawl records outside the listed domains and without a word in their url."""
    hosts = load(spark, d, "keep_targets").where("domain <> '*'").select(F.col("domain").alias("host"))
    return filters.url_filter(load(spark, d, "crawl_records").select("record_id", "url"), F.col("url"), hosts, ("tag", "login")).select("record_id")


@query
def domain_filter(spark, d):
    """(record_id): crawl records whose domain has a target."""
    allowed = load(spark, d, "keep_targets").select("domain")
    return filters.domain_filter(load(spark, d, "crawl_records"), urls.domain_of(F.col("domain"), F.col("url")), allowed).select("record_id")


def _judged(spark, d):
    """Documents with a score column as judges leave it: numbers, junk, nulls."""
    n = F.col("doc_id") % 10
    score = F.when(n == 0, F.lit(None)).when(n == 1, F.lit("-1")).when(n == 2, F.lit("4分")).when(n == 3, F.lit(" 3 ")).when(n == 4, F.lit("")).otherwise((n - 4).cast("string"))
    return _docs(spark, d).select("doc_id", "source", "text", score.alias("reply"))


@query
def score_validate(spark, d):
    """(doc_id, score): replies as scores, unusable ones -1."""
    return _judged(spark, d).select("doc_id", text.score_of_reply(F.col("reply")).alias("score"))


@query
def rescore_candidates(spark, d):
    """(doc_id): rows that need a new score."""
    return filters.rescore_candidates(_judged(spark, d), "reply").select("doc_id")


# --- quality filters ---


@query
def gopher_repetition(spark, d):
    """Repetition shares of every document, and whether a rule is broken."""
    shares = quality.repetition(_docs(spark, d))
    return shares.select("doc_id", *[F.round(c, 6).alias(c) for c in quality.REPETITION[1:]], quality.repetitive().alias("repetitive"))


@query
def gopher_quality(spark, d):
    """(doc_id, low_quality)."""
    return _docs(spark, d).select("doc_id", quality.low_quality(F.col("text")).alias("low_quality"))


@query
def c4_quality(spark, d):
    """(doc_id, text, bad): rewritten text and document rule."""
    rewritten = _docs(spark, d).withColumn("rewritten", quality.c4_text(F.col("text")))
    return rewritten.select("doc_id", F.col("rewritten").alias("text"), quality.c4_bad(F.col("text"), F.col("rewritten")).alias("bad"))


@query
def fineweb_quality(spark, d):
    """(doc_id, bad)."""
    return _docs(spark, d).select("doc_id", quality.fineweb_bad(F.col("text")).alias("bad"))


def filter_cascade_text(spark, d):
    return quality.cascade(_docs(spark, d), F.col("lang"), ["en"])


@query
def filter_cascade(spark, d):
    """(doc_id, reject_stage): first failing stage, null for survivors."""
    return filter_cascade_text(spark, d).select("doc_id", "reject_stage")


@query
def cascade_report(spark, d):
    """(stage, docs): documents by outcome."""
    return filter_cascade(spark, d).groupBy(F.coalesce("reject_stage", F.lit("kept")).alias("stage")).agg(F.count(F.lit(1)).alias("docs"))


# --- dedup, sets, joins ---


@query
def dedup_text(spark, d):
    """(doc_id): first document of every text."""
    return dedup.keep_first(_docs(spark, d), ["text"], "doc_id").select("doc_id")


@query
def dedup_rows(spark, d):
    """Distinct predictions."""
    return dedup.dedup_rows(load(spark, d, "predictions").select("pred_id", "domain", "prob"))


@query
def dedup_metrics(spark, d):
    """(total, duplicated, remain) of texts."""
    return dedup.dedup_metrics(_docs(spark, d), ["text"])


@query
def dedup_stats(spark, d):
    """Dedup figures by url and text over all documents."""
    return dedup.dedup_stats(_docs(spark, d), hashing.row_md5(F.col("url"), F.col("text")))


@query
def dedup_cross(spark, d):
    """(doc_id): documents new against the texts of the filtered corpus."""
    known = load(spark, d, "filtered_corpus").select(hashing.row_md5(F.col("text")).alias("record_key"))
    return dedup.new_records(_docs(spark, d), hashing.row_md5(F.col("text")), "doc_id", known).select("doc_id")


@query
def bloom_shard(spark, d):
    """(seen_key, shard)."""
    return load(spark, d, "seen_keys").select("seen_key", hashing.shard_of(F.col("seen_key")).alias("shard"))


@query
def bloom_check(spark, d):
    """(request_id, pos, known): whether each requested key is in the registry."""
    asked = load(spark, d, "check_requests").select("request_id", F.posexplode("elements").alias("pos", "key"))
    return registry.check(asked, load(spark, d, "seen_keys").select(F.col("seen_key").alias("key"))).select("request_id", "pos", "known")


@query
def registry_status(spark, d):
    """(shard, keys) of the registry."""
    return registry.status(load(spark, d, "seen_keys").select(F.col("seen_key").alias("key")))


@query
def registry_add(spark, d):
    """(shard, keys) after the requested keys have been added to a persistent registry."""
    table = registry.KeyRegistry(spark, _fresh(spark, "registry"))
    table.add(load(spark, d, "seen_keys").select(F.col("seen_key").alias("key")))
    table.add(load(spark, d, "check_requests").select(F.explode("elements").alias("key")))
    return table.status()


@query
def minhash_signature(spark, d):
    """(doc_id, signature): 112 minima over five-word shingles."""
    return minhash.signatures(minhash.shingles(_docs(spark, d)))


@query
def minhash_signature_fast(spark, d):
    """(doc_id, signature): the same, made in Arrow batches without a shuffle."""
    return minhash.fast_signatures(_docs(spark, d)).select("doc_id", "signature")


@query
def minhash_pairs(spark, d):
    """(a, b): each document of a bucket with the bucket's first."""
    return minhash.bucket_links(minhash.bands(minhash.fast_signatures(_docs(spark, d))))


@query
def minhash_clusters(spark, d):
    """(id, label): clusters of documents that share buckets."""
    return components.components(minhash_pairs(spark, d))


@query
def minhash_dedup(spark, d):
    """(doc_id): documents that are the first of their cluster."""
    removed = minhash_clusters(spark, d).where("id <> label").select(F.col("id").alias("doc_id"))
    return _docs(spark, d).select("doc_id").join(removed, "doc_id", "left_anti")


@query
def near_duplicates(spark, d):
    """(doc_id, class_id, links): verified near-duplicate classes of similarity 0.8 and more."""
    return minhash.near_duplicates(_docs(spark, d), short_copies=True)


@query
def union_merge(spark, d):
    """(table, rows, with_lang): documents and benchmark items as one table."""
    both = dedup.union_by_name(_docs(spark, d).select("text", "lang", F.lit("documents").alias("table")), load(spark, d, "benchmark").select("text", F.lit("benchmark").alias("table")))
    return both.groupBy("table").agg(F.count(F.lit(1)).alias("rows"), F.count("lang").alias("with_lang"))


def _texts(spark, d):
    return dedup.union_by_name(_docs(spark, d).select("text"), load(spark, d, "filtered_corpus").select("text"))


@query
def merge_dataset(spark, d):
    """(text): both corpora after length filter, cleaning and dedup."""
    return filters.length_filter(_texts(spark, d)).select(text.clean_text(F.col("text")).alias("text")).where("text <> ''").distinct()


@query
def merge_train_data(spark, d):
    """(text): both corpora after cleaning and dedup."""
    return _texts(spark, d).select(text.clean_text(F.col("text")).alias("text")).where("text <> ''").distinct()


@query
def remove_overlap(spark, d):
    """(doc_id): documents whose text isn't in the filtered corpus."""
    return dedup.remove_overlap(_docs(spark, d), load(spark, d, "filtered_corpus"), F.col("text"), F.col("text")).select("doc_id")


@query
def remove_cleaned(spark, d):
    """(doc_id): documents whose cleaned text isn't among the cleaned texts of the filtered corpus."""
    clean = text.clean_text(F.col("text"))
    return dedup.remove_overlap(_docs(spark, d), load(spark, d, "filtered_corpus"), clean, clean).select("doc_id")


# --- statistics ---


@query
def url_count(spark, d):
    """(url, count) without query and fragment."""
    return stats.count_by(load(spark, d, "crawl_records"), F.regexp_replace("url", "[?#].*$", "")).withColumnRenamed("_0", "url")


@query
def domain_count(spark, d):
    """(domain, count) by host."""
    return stats.count_by(load(spark, d, "crawl_records"), urls.fqdn(F.col("url"))).withColumnRenamed("_0", "domain")


@query
def domain_count_by_file(spark, d):
    """(source, domain, count): hosts by source of documents."""
    return stats.count_by(_docs(spark, d), F.col("source"), urls.fqdn(F.col("url"))).withColumnsRenamed({"_0": "source", "_1": "domain"})


@query
def domain_rollup(spark, d):
    """(domain, count): url counts summed by host."""
    return stats.sum_by(url_count(spark, d), urls.fqdn(F.col("url"))).withColumnRenamed("key", "domain")


@query
def domain_merge(spark, d):
    """(domain, count): host counts of crawl and documents merged."""
    docs = stats.count_by(_docs(spark, d), urls.fqdn(F.col("url"))).withColumnRenamed("_0", "domain")
    return stats.sum_by(domain_count(spark, d).unionByName(docs), F.col("domain")).withColumnRenamed("key", "domain")


@query
def top_domains(spark, d):
    """(domain, count): the five most frequent hosts."""
    return domain_count(spark, d).orderBy(F.desc("count"), "domain").limit(5)


@query
def domain_ratio(spark, d):
    """(domain, base_count, other_count, ratio): https records against all, by host."""
    crawl = load(spark, d, "crawl_records")
    base = stats.count_by(crawl.where(F.col("url").startswith("https")), urls.fqdn(F.col("url"))).withColumnRenamed("_0", "domain")
    return stats.ratio_of_counts(base, domain_count(spark, d), "domain")


@query
def score_distribution(spark, d):
    """(score, count, percent) of all judged rows."""
    return stats.score_distribution(score_validate(spark, d), F.col("score"))


@query
def score_by_source(spark, d):
    """(source, score, count, percent) by source."""
    rows = _judged(spark, d).select("source", text.score_of_reply(F.col("reply")).alias("score"))
    return stats.score_distribution(rows, F.col("score"), "source")


@query
def confusion_matrix(spark, d):
    """Transport labels against scores above 0.9."""
    truth = load(spark, d, "subject_labels").groupBy("doc_id").agg(F.max(F.lower("subject") == "transport").alias("t"))
    scored = load(spark, d, "predictions").where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(~F.isnan("prob"), F.col("prob"))).alias("p"))
    return stats.confusion(scored.join(truth, "doc_id", "left"), F.col("t"), F.col("p") > 0.9)


@query
def precision_at_one(spark, d):
    """(samples, precision, recall) of the label that each document's best score stands for, against the transport labels."""
    truth = load(spark, d, "subject_labels").groupBy("doc_id").agg(F.max(F.lower("subject") == "transport").alias("t"))
    scored = load(spark, d, "predictions").where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(~F.isnan("prob"), F.col("prob"))).alias("p"))
    return stats.precision_at_one(scored.join(truth, "doc_id"), F.col("t"), F.col("p") > 0.9)


@query
def inference_report(spark, d):
    """(total, positives, share) of the predictions."""
    return stats.inference_report(_predicted(spark, d), classifier.is_positive())


# --- sampling ---


@query
def sample_per_group(spark, d):
    """(doc_id): a sample over sources."""
    rows = _docs(spark, d).where("source is not null").select("doc_id", "source", "text")
    return sampling.sample_per_group(rows, F.col("source"), F.col("doc_id"), 200, SEED).select("doc_id")


@query
def sample_clean(spark, d):
    """(text): a sample over sources, cleaned, without empty ones."""
    rows = _docs(spark, d).where("source is not null").select("doc_id", "source", "text")
    taken = sampling.sample_per_group(rows, F.col("source"), F.col("doc_id"), 200, SEED)
    return taken.select("doc_id", text.clean_text(F.col("text")).alias("text")).where("text <> ''")


def _scaled(spark, d):
    return load(spark, d, "events").select("event_id", (F.col("value") / 100).alias("prob"))


@query
def stratified_bins(spark, d):
    """(bin, rows, quota) of the event values."""
    return sampling.bin_counts(_scaled(spark, d), F.col("prob"), 503)


@query
def stratified_sample(spark, d):
    """(event_id, bin, draw): a sample with as many rows of every bin."""
    return sampling.stratified_sample(_scaled(spark, d), F.col("prob"), F.col("event_id"), 503, SEED).select("event_id", "bin", "draw")


@query
def train_val_split(spark, d):
    """(doc_id, split): 80 to 20 by language."""
    return sampling.train_val_split(_docs(spark, d).select("doc_id", "lang"), F.col("lang"), F.col("doc_id"), 0.8, SEED).select("doc_id", "split")


# --- segments, models, judge ---


@query
def sentence_split(spark, d):
    """(doc_id, seq, sentence)."""
    return segment.explode_sentences(_docs(spark, d))


@query
def segments(spark, d):
    """(doc_id, seq, segment, words)."""
    return segment.explode_segments(_docs(spark, d))


@query
def segment_invariants(spark, d):
    """(doc_id, tokens): tokens of all segments of a document, which are those of its text."""
    tokens = F.size(F.filter(F.split("segment", " "), lambda w: w != ""))
    return segments(spark, d).groupBy("doc_id").agg(F.sum(tokens).alias("tokens"))


@query
def language_id_eval(spark, d):
    """(lang, language, docs): declared against guessed language."""
    guessed = language.with_language(_docs(spark, d).where("text is not null"))
    return guessed.groupBy(F.lower(F.substring_index("lang", "-", 1)).alias("lang"), "language").agg(F.count(F.lit(1)).alias("docs"))


def _labelled(spark, d):
    """(doc_id, text, label): labelled documents, 1 for transport."""
    truth = load(spark, d, "subject_labels").groupBy("doc_id").agg(F.max((F.lower("subject") == "transport").cast("int")).alias("label"))
    return _docs(spark, d).select("doc_id", "text").where("text is not null").join(truth, "doc_id")


def _trained(spark, d):
    split = sampling.train_val_split(_labelled(spark, d), F.col("label"), F.col("doc_id"), 0.8, SEED)
    return classifier.train(split.where("split = 'train'")), split.where("split = 'val'")


@query
def classifier_train(spark, d):
    """Evaluation of the classifier on the held-out fifth."""
    model, held_out = _trained(spark, d)
    predicted = classifier.predict(held_out.withColumnRenamed("label", "truth"), model)
    return stats.confusion(predicted, F.col("truth") == 1, F.col("label") == "__label__1")


@query
def classifier_predict(spark, d):
    """(doc_id, label, prob) of every document."""
    model, _ = _trained(spark, d)
    return classifier.predict(_docs(spark, d).select("doc_id", "text"), model).select("doc_id", "label", "prob")


@query
def judge_scores(spark, d):
    """(doc_id, score) by the offline judge."""
    return judge.judge(_docs(spark, d), "doc_id")


@query
def judge_rescored(spark, d):
    """(doc_id, score): valid scores kept, all others judged."""
    return judge.rescored(_judged(spark, d), "doc_id", "reply").select("doc_id", F.col("reply").alias("score"))




# --- more sinks, pipelines ---


@query
def append_csv(spark, d):
    """(i, rows): a CSV table written in two appends and read again."""
    path = _fresh(spark, "append")
    for k in (0, 1):
        writers.write(load(spark, d, "benchmark").where(F.col("item_id") % 2 == k).select("item_id", "task"), path, "csv", mode="append")
    return readers.read_csv(spark, path, "item_id long, task string").groupBy("task").agg(F.count(F.lit(1)).alias("rows"))


@query
def convert_jsonl_csv(spark, d):
    """(item_id, task): benchmark items written as JSON lines, converted to CSV and read again."""
    source, target = _fresh(spark, "items.jsonl"), _fresh(spark, "items-csv")
    writers.write(load(spark, d, "benchmark").select("item_id", "task"), source, "jsonl", compression="gzip")
    writers.convert(spark, source, "item_id long, task string", target, "csv")
    return readers.read_csv(spark, target, "item_id long, task string")


@query
def failed_files(spark, d):
    """(item_id): items read file by file from good zstd files; -1 for each of two files that are broken."""
    path = _fresh(spark, "by-file")
    writers.write(load(spark, d, "benchmark").select("item_id"), f"{path}/good", "jsonl", compression="zstd")
    for k, line in enumerate(('{"item_id": 1}\n{"item_id": 2', "no json")):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path}/bad{k}", compression="gzip" if k else None)
    rows, failed = readers.read_jsonl_by_file(spark, path, T.StructType.fromDDL("item_id long"))
    return rows.select("item_id").unionByName(failed.select(F.lit(-1).cast("long").alias("item_id")))


@query
def rejects_by_language(spark, d):
    """(language, rows): documents that aren't English, written by guessed language ('none' without one) and read again."""
    path = _fresh(spark, "by-language")
    told = language.with_language(_docs(spark, d).select("doc_id", "text"))
    rejected = told.where("not language <=> 'en'").select("doc_id", F.coalesce("language", F.lit("none")).alias("language"))
    writers.write_rejects(rejected, path, "language")
    return spark.read.schema("doc_id long, language string").json(path).groupBy("language").agg(F.count(F.lit(1)).alias("rows"))


@query
def pipeline_corpus(spark, d):
    """(reject_stage, docs) of the corpus pipeline over all documents, by source; by site of the url where source is null."""
    folder = F.coalesce("source", urls.site_of(F.col("url"), F.col("source")), F.lit(""))
    docs = _docs(spark, d).select("doc_id", folder.alias("folder"), "text")
    return pipelines.curate(docs).groupBy(F.coalesce("reject_stage", F.lit("kept")).alias("reject_stage")).agg(F.count(F.lit(1)).alias("docs"))


@query
def pipeline_dedup(spark, d):
    """(folder, shard, rows): documents with unseen keys in rolling shards; an earlier run had taken those declared German."""
    path = _fresh(spark, "shards")
    docs = _docs(spark, d).select("doc_id", "url", "text", "lang")
    known = docs.where(F.lower("lang").startswith("de")).select(hashing.row_sha(F.col("url"), F.col("text")).alias("record_key"))
    pipelines.run_dedup(docs.drop("lang"), path, "doc_id", known=known, shard_rows=SHARD_ROWS)
    written = spark.read.schema("doc_id long, folder string, shard string").json(path)
    return written.groupBy("folder", "shard").agg(F.count(F.lit(1)).alias("rows"))


@query
def pipeline_shards(spark, d):
    """(doc_id, shard): the same records in shard files, with the file that each is read from."""
    path = _fresh(spark, "shard-files")
    docs = _docs(spark, d).select("doc_id", "url", "text", "lang")
    known = docs.where(F.lower("lang").startswith("de")).select(hashing.row_sha(F.col("url"), F.col("text")).alias("record_key"))
    pipelines.run_dedup(docs.drop("lang"), path, "doc_id", known=known, shard_rows=SHARD_ROWS, as_files=True)
    written = readers.read_jsonl(spark, path, T.StructType.fromDDL("doc_id long"), glob="*.jsonl.zst")
    return written.select("doc_id", F.regexp_extract("_metadata.file_path", "shard_[0-9]+/shard_[0-9]+[.]jsonl[.]zst$", 0).alias("shard"))


@query
def csv_dedup(spark, d):
    """(total, duplicated, remain) of a CSV file's rows by text, as they are written once per text."""
    source, target = _fresh(spark, "with-copies"), _fresh(spark, "without")
    writers.write(_table_of_docs(spark, d).where("text <> ''"), source, "csv")
    found = pipelines.dedup_csv(spark, source, "doc_id long, url string, text string, lang string", target, ["text"], low=20, high=100_000)
    written = readers.read_csv(spark, target, "doc_id long, url string, text string, lang string").agg(F.count(F.lit(1)).alias("written"))
    return found.join(F.broadcast(written))  # one row each


@query
def csv_merge(spark, d):
    """(task, rows): benchmark items in CSV files at several depths, merged to one table and read again."""
    source, target = _fresh(spark, "csv-tree"), _fresh(spark, "csv-merged")
    for k, folder in enumerate(("", "/a", "/a/b")):
        writers.write(load(spark, d, "benchmark").where(F.length("task") % 3 == k).select("item_id", "task"), source + folder, "csv", mode="append")
    pipelines.merge_csv(spark, source, "item_id long, task string", target)
    return readers.read_csv(spark, target, "item_id long, task string").groupBy("task").agg(F.count(F.lit(1)).alias("rows"))


@query
def pipeline_classifier(spark, d):
    """(doc_id): documents that a classifier of transport texts keeps."""
    labelled = _labelled(spark, d)
    kept, _ = pipelines.run_classifier(labelled.where("label = 1").select("text"), labelled.where("label = 0").select("text"), _docs(spark, d).select("doc_id", "text"))
    return kept.select("doc_id")


@query
def domain_corpus(spark, d):
    """(digest): texts of hosts with at least ten documents, once each."""
    allowed = stats.count_by(_docs(spark, d), urls.fqdn(F.col("url"))).where(F.col("count") >= 10).select(F.col("_0").alias("domain"))
    return pipelines.domain_corpus(_docs(spark, d).select("url", "text"), allowed).select(F.md5("text").alias("digest"))
