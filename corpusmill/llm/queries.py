"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import urls
from corpusmill.llm import blocks, boilerplate, cutoff, frequent, langid, leak, lexicon, seen, spam, subjects, textstats, tokens
from corpusmill.scratch import materialize
from corpusmill.sources.tables import load, load_texts


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """(attr, item): urls with 0.5 % and domains with 1 % of the crawl records that have one."""
    return p1_counts(spark, directory).select("attr", "item")


def p1_counts(spark: SparkSession, directory: str) -> DataFrame:
    """(attr, item, n, total): the items of p1_found with their counts."""
    records = load(spark, directory, "crawl_records")
    domain = urls.domain_of(F.col("domain"), F.col("url"))
    return frequent.frequent_items(records, {"url": (F.col("url"), "0.005"), "domain": (domain, "0.01")})


def _arrivals(spark: SparkSession, directory: str) -> seen.Arrivals:
    crawl = load(spark, directory, "crawl_records").select(F.lit("crawl_records").alias("stream"), F.col("record_id").alias("id"), F.lit(0).alias("pos"), F.col("url").alias("key"))
    requests = load(spark, directory, "check_requests").select(F.lit("check_requests").alias("stream"), F.col("request_id").alias("id"), F.posexplode("elements").alias("pos", "key"))
    streams = F.explode(F.array(F.lit("crawl_records"), F.lit("check_requests"))).alias("stream")
    known = load(spark, directory, "seen_keys").select(streams, F.col("seen_key").alias("key"))
    return seen.arrivals(crawl.unionByName(requests), known)


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """(tbl, id, pos): the urls and request elements whose key came before."""
    found = seen.answers(_arrivals(spark, directory)).where("seen")
    return found.select(F.col("stream").alias("tbl"), "id", "pos")


def p3_errors(spark: SparkSession, directory: str) -> DataFrame:
    """(stream, asked, seen, wrong, wrong_rate, in_bound): how often the Bloom chains were wrong."""
    return seen.error_report(seen.answers(_arrivals(spark, directory)))


def p3_counts(spark: SparkSession, directory: str) -> DataFrame:
    """(stream, asked, seen, in_bound): keys asked and seen before, and whether the rate of wrong answers keeps its bound."""
    return p3_errors(spark, directory).select("stream", "asked", "seen", "in_bound")


def p3_service(spark: SparkSession, directory: str) -> DataFrame:
    """(request_id, pos, maybe): requested keys asked of chains that were kept of the known keys and crawled urls."""
    known = load(spark, directory, "seen_keys").select(F.col("seen_key").alias("key"))
    urls_ = load(spark, directory, "crawl_records").select(F.col("url").alias("key"))
    shards = seen.shards_for(known.count() + urls_.count(), spark.sparkContext.defaultParallelism)
    chains = materialize(seen.extend_chains(known, shards), "chains")
    chains = materialize(seen.extend_chains(urls_, shards, chains), "chains")
    asked = load(spark, directory, "check_requests").select("request_id", F.posexplode("elements").alias("pos", "key"))
    return seen.ask_chains(asked, shards, chains).select("request_id", "pos", "maybe")


def _texts(spark: SparkSession, directory: str) -> DataFrame:
    """(tbl, id, text, label) of documents and filtered_corpus."""
    docs = load_texts(spark, directory, "documents").select(F.lit("documents").alias("tbl"), F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("label"))
    corpus = load_texts(spark, directory, "filtered_corpus").select(F.lit("filtered_corpus").alias("tbl"), "id", "text", F.try_element_at("metadata", F.lit("language")).alias("label"))
    return docs.unionByName(corpus)


def _segments(spark: SparkSession, directory: str) -> DataFrame:
    """SEGMENTS with tbl and the declared label of the row."""
    texts = _texts(spark, directory)
    model = langid.fit(texts.select(F.concat_ws(":", "tbl", "id").alias("id"), "text", "label"))
    # the row's table and label travel in its id, so that no join is needed to get them back
    packed = F.to_json(F.struct("tbl", "id", langid.primary_label(F.col("label")).alias("label")))
    found = langid.segments(texts.select(packed.alias("id"), "text"), model)
    return found.select(F.from_json("id", "tbl string, id string, label string").alias("r"), "seg_no", "lang", "confidence").select("r.*", "seg_no", "lang", "confidence")


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """(tbl, id, seg_no, lang): missing or wrong labels (seg_no -1) and lines in another language."""
    found = _segments(spark, directory).where((F.col("seg_no") >= 0) | ~F.col("label").eqNullSafe(F.col("lang")))
    return found.select("tbl", "id", "seg_no", "lang").distinct()


def p2_labels(spark: SparkSession, directory: str) -> DataFrame:
    """(tbl, id, seg_no, lang, confidence): the language of every text and deviating line."""
    return _segments(spark, directory).groupBy("tbl", "id", "seg_no", "lang").agg(F.max("confidence").alias("confidence"))


def _scores(spark: SparkSession, directory: str) -> DataFrame:
    rows = load(spark, directory, "predictions")
    return cutoff.valid_records(rows, F.col("pred_id"), urls.domain_of(F.col("domain"), F.col("url")), F.col("prob"))


def _targets(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, directory, "keep_targets").select(F.col("domain").alias("source"), "keep_pct")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """(pred_id): the records that their domain's cutoff keeps."""
    valid = materialize(_scores(spark, directory), "valid")  # read by the cutoffs and for what they keep
    return cutoff.kept_records(valid, cutoff.cutoffs(valid, _targets(spark, directory))).select(F.col("rec").alias("pred_id")).distinct()


def p4_cutoffs(spark: SparkSession, directory: str) -> DataFrame:
    """(domain, n, target, cutoff, kept): the cutoff of each domain with valid records."""
    return cutoff.cutoffs(_scores(spark, directory), _targets(spark, directory)).withColumnRenamed("source", "domain")


def site_documents(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, site, day, text, lang) of the documents."""
    docs = load_texts(spark, directory, "documents")
    return docs.select("doc_id", urls.site_of(F.col("url"), F.col("source")).alias("site"), F.to_date("fetched_at").alias("day"), "text", "lang")


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, line_no): lines that at least five documents of their site hold."""
    return boilerplate.boilerplate(site_documents(spark, directory))


def p5_lines(spark: SparkSession, directory: str) -> DataFrame:
    """(site, line, docs, clusters, days): the lines of p5_found with their documents, distinct documents and dates."""
    return boilerplate.line_report(site_documents(spark, directory))


def p5_boilerplate(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, line_no): the places of p5_found's lines that stand in five distinct documents, of two dates at least.

    Unlike p5_found this leaves the lines of an article that is published again and again.
    """
    return boilerplate.boilerplate(site_documents(spark, directory), min_clusters=boilerplate.MIN_DOCS, min_days=2)


def p5_clean(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, text): every document's text without the lines of p5_found."""
    docs = site_documents(spark, directory)
    return boilerplate.without_lines(docs, boilerplate.boilerplate(docs)).select("doc_id", "text")


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, subject): the subjects that at least a third of a document's units are about."""
    return subjects.assigned(p6_scores(spark, directory)).select("doc_id", "subject")


def p6_scores(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, subject, about, judged, units, chars, confidence): units by subject, lines of p5_found left aside."""
    docs = site_documents(spark, directory)
    names = [r.subject for r in load(spark, directory, "subjects").select("subject").sort("subject").collect()]  # the subject areas
    model = subjects.fit(docs, load(spark, directory, "subject_labels"), names)
    return subjects.scores(boilerplate.marked(docs.select("doc_id", "text"), boilerplate.boilerplate(docs)), model)


def p6_mix(spark: SparkSession, directory: str) -> DataFrame:
    """(subject, docs, units): how much of the corpus is about each subject."""
    found = subjects.assigned(p6_scores(spark, directory))
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("docs"), F.sum("about").alias("units"))


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id): documents that are mostly lists, tables, stuffing or junk instead of sentences."""
    return p7_stats(spark, directory).where("not_prose").select("doc_id")


def p7_stats(spark: SparkSession, directory: str) -> DataFrame:
    """Statistics of every document with text; see textstats.statistics."""
    docs = load_texts(spark, directory, "documents")
    table = blocks.read(docs, of_text=textstats.count_text)  # read by the rounds of the lexicon and for the sums
    return textstats.statistics(textstats.sums(docs, lexicon=lexicon.fit_blocks(table), table=table))


def p7_sums(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, chars, symbols, lines, ended_lines): the sums of p7_stats that need no lexicon."""
    return textstats.sums(load_texts(spark, directory, "documents")).select("doc_id", "chars", "symbols", "lines", "ended_lines")


def p8_ids(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, ids): every document's text in the vocabulary byte_bpe_50k."""
    return tokens.encode(load_texts(spark, directory, "documents"))


def p8_decoded(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, text): the texts again, decoded from p8_ids; null has become the empty text."""
    return tokens.decode(p8_ids(spark, directory), tokens.token_table(spark))


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, item_id): documents that hold at least 12 consecutive words of an evaluation item."""
    return leak.phrases(leak.build_index(load_texts(spark, directory, "documents")), load(spark, directory, "benchmark"))


def p9_near(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, item_id, terms): documents with most of an item's rarest terms close together."""
    return leak.near_matches(leak.build_index(load_texts(spark, directory, "documents")), load(spark, directory, "benchmark"))


def p9_items(spark: SparkSession, directory: str) -> DataFrame:
    """(item_id, docs): the leaked items and the number of documents that hold them."""
    return p9_found(spark, directory).groupBy("item_id").agg(F.count(F.lit(1)).alias("docs"))


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id): pages that are mostly search keywords, links or product tags."""
    return spam.stuffed(p10_pages(spark, directory)).select("doc_id")


def p10_pages(spark: SparkSession, directory: str) -> DataFrame:
    """(doc_id, chars, covered, clauseless, spam_share) of every document with text."""
    table = blocks.read(load_texts(spark, directory, "documents"))  # read by the rounds of the lexicon and for the pages
    return spam.measure_blocks(table, lexicon.fit_blocks(table))


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_labels, p3_found, p3_counts, p3_errors, p3_service, p4_found, p4_cutoffs, p5_found, p5_lines, p5_boilerplate, p5_clean, p6_found, p6_scores, p6_mix, p7_found, p7_stats, p7_sums, p8_ids, p8_decoded, p9_found, p9_near, p9_items, p10_found, p10_pages)}
