"""A small native language label: the language whose stop words are most frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed lists of frequent words that the languages don't share.
STOP_WORDS = {
    "en": "the of and to that with was which have this from they will been would".split(),
    "de": "der die und das nicht mit ist ein dem für auf sich wird bis sind".split(),
    "fr": "les des est pas que pour dans une qui sur plus par avec ses sera".split(),
    "es": "los las una por con para del como pero más hasta según será ya está".split(),
}
#: Lists of further languages, for callers that pass them.
MORE_STOP_WORDS = STOP_WORDS | {
    "it": "il gli della che sono nel dalla anche questo essere più alla dei".split(),
    "pt": "os uma não com dos são ao pela mais seu também foi pelo".split(),
    "nl": "het een van zijn niet voor ook maar wordt deze naar bij nog".split(),
    "pl": "nie jest się że jak który przez tylko oraz jego także".split(),
    "sv": "och att det som inte har till den från eller också".split(),
}


def _hits(words: Column, stop: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(stop)))


def guess(text: Column, languages: dict[str, list[str]] = STOP_WORDS) -> Column:
    """Struct (language, score): hits per word of the best language; language null without any hit or for null text.

    Ties go to the first language of the dictionary.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+"), F.lit(0))
    hits = {lang: _hits(words, stop) for lang, stop in languages.items()}
    best = F.greatest(*hits.values(), F.lit(0))
    name = F.lit(None).cast("string")
    for lang in reversed(list(hits)):
        name = F.when(hits[lang] == best, F.lit(lang)).otherwise(name)
    score = F.coalesce(F.try_divide(best, F.size(words)), F.lit(0.0))
    return F.struct(F.when(best > 0, name).alias("language"), score.alias("score"))


def with_language(df: DataFrame, text: str = "text", languages: dict[str, list[str]] = STOP_WORDS) -> DataFrame:
    """df with columns language and language_score."""
    return df.withColumn("_guess", guess(F.col(text), languages)).select("*", F.col("_guess.language").alias("language"), F.col("_guess.score").alias("language_score")).drop("_guess")
