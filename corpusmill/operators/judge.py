"""Relevance scores 0-5 by an injected judge; offline, a deterministic keyword scorer."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import clean_whitespace, numeric, score_of_reply

#: Words that count for the offline scorer: the topical domain of the corpus.
KEYWORDS = ("bus", "tram", "train", "rail", "metro", "road", "traffic", "lorry", "ferry", "freight", "timetable", "passenger", "station", "vehicle")


#: A usable reply.
SCORE = re.compile(r"\s*[0-5]\s*")


def keyword_reply(texts: list[str]) -> list[str]:
    """A reply per text: how many of the keywords it holds, at most 5."""
    return [str(min(5, sum(k in t.lower() for k in KEYWORDS))) for t in texts]


#: Texts asked for at a time, and times that a text without a usable reply is asked for once more.
CALL_TEXTS, RETRIES = 500, 2


def replies_of(texts: list[str], reply: Callable[[list[str]], list[str]], retries: int = RETRIES) -> list[str]:
    """A reply per text: texts whose call failed or whose reply is no score are asked for again, each by itself."""

    def call(some: list[str]) -> list[str] | None:
        try:
            answers = reply(some)
        except Exception:  # whatever a service may raise
            return None
        return list(answers) if len(answers) == len(some) else None

    found = call(texts) or [""] * len(texts)
    for i, text in enumerate(texts):
        for _ in range(retries):
            if SCORE.fullmatch(found[i] or ""):
                break
            found[i] = (call([text]) or [""])[0]
    return found


def judge(df: DataFrame, key: str, reply: Callable[[list[str]], list[str]] = keyword_reply, text: str = "text", retries: int = RETRIES) -> DataFrame:
    """(key, score) of every row: empty and null texts 0 without asking, unusable replies and errors -1.

    reply gets up to CALL_TEXTS texts at a time; limits of a service are its
    business. A failed call costs only the texts that fail by themselves, too,
    after so many retries. Nothing here uses the network.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies = pd.Series(["0"] * len(pdf), index=pdf.index, dtype=object)
            asked = pdf.index[pdf["text"] != ""]
            for at in range(0, len(asked), CALL_TEXTS):
                some = asked[at : at + CALL_TEXTS]
                replies.loc[some] = replies_of(pdf.loc[some, "text"].tolist(), reply, retries)
            yield pd.DataFrame({"k": pdf["k"], "reply": replies})

    kind = df.schema[key].dataType.simpleString()
    asked = df.select(F.col(key).alias("k"), clean_whitespace(F.col(text)).alias("text"))
    return asked.mapInPandas(ask, f"k {kind}, reply string").select(F.col("k").alias(key), score_of_reply(F.col("reply")).alias("score"))


def rescored(df: DataFrame, key: str, score: str, reply: Callable[[list[str]], list[str]] = keyword_reply) -> DataFrame:
    """df with the score of every row that had a valid one kept, and all others judged."""
    value = numeric(F.col(score))
    valid = value.between(0, 5)
    done = df.where(valid).withColumn(score, value.cast("int"))
    todo = df.where(~F.coalesce(valid, F.lit(False))).drop(score)
    judged = todo.join(judge(todo, key, reply).withColumnRenamed("score", score), key)
    return done.unionByName(judged.select(*df.columns))


def judge_saved(df: DataFrame, key: str, path: str, reply: Callable[[list[str]], list[str]] = keyword_reply, text: str = "text", parts: int = 16) -> DataFrame:
    """(key, score) as judge gives it, saved below path part by part; a second call goes on where an earlier one ended.

    Rows fall into parts by a hash of their key (unique, not null). A part whose scores are
    there isn't asked for again.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    for p in range(parts):
        place = f"{path}/part={p}"
        if not system.exists(hadoop(f"{place}/_SUCCESS")):
            judge(df.where(part == p), key, reply, text).write.mode("overwrite").parquet(place)
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, score int"
    return spark.read.schema(schema).parquet(*[f"{path}/part={p}" for p in range(parts)])
