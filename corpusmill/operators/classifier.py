"""A binary text classifier: label lines, training, prediction, evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.labels import PREFIX
from corpusmill.functions.text import flatten_newlines
from corpusmill.operators.dedup import remove_overlap

NGRAMS, FEATURES = 3, 1 << 16


def training_set(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """(text, label): positives as 1, negatives that aren't also positive as 0; null texts dropped."""
    clean = remove_overlap(negative.select("text"), positive, F.col("text"), F.col("text"))
    return positive.select("text", F.lit(1).alias("label")).unionByName(clean.select("text", F.lit(0).alias("label"))).where(F.col("text").isNotNull())


def train(labelled: DataFrame, ngrams: int = NGRAMS, features: int = FEATURES, iterations: int = 20, min_docs: int = 1) -> PipelineModel:
    """A model of (text, label 0 or 1): hashed word n-grams of 1 to ngrams words and logistic regression.

    Hashing needs no vocabulary, so training scales with the rows alone.
    Features of fewer than min_docs texts are not used.
    """
    stages = [RegexTokenizer(inputCol="flat", outputCol="w1", pattern=r"[^\p{L}\p{N}']+", toLowercase=True)]
    stages += [NGram(n=n, inputCol="w1", outputCol=f"w{n}") for n in range(2, ngrams + 1)]
    stages += [HashingTF(inputCol=f"w{n}", outputCol=f"f{n}", numFeatures=features) for n in range(1, ngrams + 1)]
    raw = "features" if min_docs <= 1 else "counts"
    stages += [VectorAssembler(inputCols=[f"f{n}" for n in range(1, ngrams + 1)], outputCol=raw)]
    if min_docs > 1:
        stages += [IDF(inputCol=raw, outputCol="features", minDocFreq=min_docs)]
    stages += [LogisticRegression(maxIter=iterations, regParam=0.01, labelCol="label")]
    rows = labelled.select(flatten_newlines(F.col("text")).alias("flat"), F.col("label").cast("double").alias("label"))
    return Pipeline(stages=stages).fit(rows)


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """df with label (__label__0 or __label__1) and prob of that label; null texts are scored as empty."""
    flat = df.withColumn("flat", flatten_newlines(F.coalesce("text", F.lit(""))))
    scored = model.transform(flat)
    label = F.concat(F.lit(PREFIX), F.col("prediction").cast("int").cast("string"))
    prob = F.array_max(vector_to_array("probability"))
    return scored.select(*[c for c in df.columns if c not in ("label", "prob")], label.alias("label"), prob.alias("prob"))


def predict_external(df: DataFrame, load: Callable[[], Callable[[list[str]], tuple[list[str], list[float]]]]) -> DataFrame:
    """df with label and prob of an external model; load runs once per task and gives a function of texts."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            labels, probs = model([t.replace("\n", " ") for t in pdf["text"].fillna("")])
            yield pdf.assign(label=labels, prob=probs)

    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInPandas(score, ", ".join([*names, "label string", "prob double"]))


def is_positive(label: str = "label", prob: str = "prob", above: float = 0.9) -> Column:
    """Whether a prediction is positive: top label 1 and a probability strictly above the bound."""
    return (F.col(label) == PREFIX + "1") & (F.col(prob) > above)
