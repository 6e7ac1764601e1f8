import json
import random

from pyspark.sql import functions as F

from corpusmill.plans import pipelines, queries as plans



def text(n, folder=0):
    source = random.Random(n * 10 + folder)
    words = lambda k: " ".join("".join(source.choice("aeioubcdfglmnprst") for _ in range(6)) for _ in range(k))
    return "\n".join(f"The {words(5)} of {words(4)} and that {words(5)}. They have been with {words(6)} to {words(3)}." for _ in range(4))


def test_corpus_pipeline(spark, rows, tmp_path):
    for folder in (0, 1):
        (tmp_path / f"in/f{folder}").mkdir(parents=True)
        with open(tmp_path / f"in/f{folder}/x.jsonl", "w") as out:
            texts = [text(1), text(1), text(2, folder), "too short and the rest of it", "der Bus und die Bahn sind nicht da", ""]
            for i, t in enumerate(texts):
                out.write(json.dumps({"warc_record_id": f"{folder}-{i}", "url": "http://a.b/", "text": t}) + "\n")
    report = dict(pipelines.run_corpus(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect())
    assert sum(report.values()) == 12 and report["minhash"] == 2 and report["kept"] == 4 and report["language"] == 4
    kept = spark.read.schema("warc_record_id string, folder string").json(f"file://{tmp_path}/out/kept")
    assert {r.folder for r in kept.collect()} == {"f0", "f1"} and kept.count() == 4
    removed = spark.read.schema("text string, folder string, reject_stage string").json(f"file://{tmp_path}/out/removed")
    assert removed.count() == 8


def test_global_scope_removes_across_folders(spark, frame):
    docs = frame([(1, "a", text(1)), (2, "b", text(1)), (3, "b", text(2))], "doc_id long, folder string, text string")
    by_scope = {s: pipelines.curate(docs, pipelines.CorpusOptions(scope=s)).where("reject_stage = 'minhash'").count() for s in ("folder", "global")}
    assert by_scope == {"folder": 0, "global": 1}


def test_dedup_runs_in_turn(spark, frame, rows, tmp_path):
    schema = "i long, url string, text string"
    one, two = frame([(1, "u", "x" * 30), (2, "u", "x" * 30), (3, "v", "y" * 30)], schema), frame([(4, "v", "y" * 30), (5, "w", "z" * 30), (6, "w", None)], schema)
    keys = pipelines.run_dedup(one, f"file://{tmp_path}/a", "i", shard_rows=1).persist()
    assert keys.count() == 2
    more = pipelines.run_dedup(two, f"file://{tmp_path}/b", "i", known=keys, shard_rows=1)
    assert more.count() == 1
    assert rows(spark.read.schema("i long, folder string, shard string").json(f"file://{tmp_path}/b")) == [(5, "shard_01", "shard_00001.")] or rows(spark.read.json(f"file://{tmp_path}/b").select("i")) == [(5,)]


def test_classifier_round(spark, frame):
    positive = frame([(f"the bus and tram number {i}",) for i in range(60)] + [(None,)], "text string")
    negative = frame([(f"the cake and bread number {i}",) for i in range(60)] + [("the bus and tram number 1",), (None,)], "text string")
    corpus = frame([(1, "a bus and a tram"), (2, "bread and cake"), (3, None)], "doc_id long, text string")
    kept, evaluation = pipelines.run_classifier(positive, negative, corpus, above=0.5)
    assert [r.doc_id for r in kept.select("doc_id").collect() if r.doc_id != 3] == [1]
    assert evaluation.select(F.col("accuracy")).first()[0] > 0.9


def test_rejects_by_language_keeps_texts_without_a_language(frame, tmp_path):
    texts = ["the end of the road", "der Zug und die Bahn", "今天天气很好", "xyz", "", None]
    frame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(plans.QUERIES["rejects_by_language"](frame([], "x int").sparkSession, str(tmp_path)).collect())
    assert got == {"de": 1, "none": 4}


def test_pipeline_corpus_counts_documents_without_source(frame, tmp_path):
    docs = [(1, text(1), "a.b", None), (2, text(2), None, "http://www.c.d/x"), (3, text(2), None, "http://c.d/y"), (4, "der Bus und die Bahn", None, "?"), (5, None, None, "http://c.d/")]
    frame(docs, "doc_id long, text string, source string, url string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(plans.QUERIES["pipeline_corpus"](frame([], "x int").sparkSession, str(tmp_path)).collect())
    assert got == {"kept": 2, "minhash": 1, "language": 2}
