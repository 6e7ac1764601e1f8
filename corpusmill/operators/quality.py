"""Heuristic quality filters: repetition, quality, line rules, and the cascade over them.

All rules look at one document, so nothing is shuffled. The repetition rules
need counts of n-grams; they run as one Arrow batch function over NumPy arrays,
the others as native expressions. Every threshold is a keyword.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import WS
from corpusmill.operators.filters import first_failing

# Fixed values of the published rules.
TOP_NGRAMS = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
STOP_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with"]
POLICY = "terms of use|privacy policy|cookie policy|uses cookies|use of cookies|use cookies"

_PARTS = ("dup_lines", "dup_line_chars", "dup_paragraphs", "dup_paragraph_chars")
REPETITION = ["doc_id", *_PARTS, *(f"top_{n}" for n in TOP_NGRAMS), *(f"dup_{n}" for n in DUPLICATE_NGRAMS)]


def words(text: Column) -> Column:
    """Words between white space; null gives null."""
    return F.filter(F.split(text, WS + "+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Non-blank lines, trimmed."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, f"^{WS}+|{WS}+$", "")), lambda x: x != "")


def _repeated(parts: list[str]) -> tuple[float, float]:
    """(share of parts that stood before, share of characters in them)."""
    seen: set[str] = set()
    again = chars = total = 0
    for p in parts:
        total += len(p)
        if p in seen:
            again += 1
            chars += len(p)
        seen.add(p)
    return (again / len(parts), chars / total) if total else (0.0, 0.0)


def repetition_shares(text: str | None) -> list[float]:
    """REPETITION without doc_id for a text; zeros for null, blank and too short texts.

    N-gram shares are of the characters in words: top_n of the most frequent
    n-gram (the one with most characters among ties), if it stands more than
    once; dup_n of the words inside n-grams that stand more than once.
    """
    text = text or ""
    trim = " \t\n\x0b\x0c\r"
    line = [x for x in (y.strip(trim) for y in text.split("\n")) if x]
    paragraph = [x for x in (y.strip(trim) for y in text.split("\n\n")) if x]
    out = [*_repeated(line), *_repeated(paragraph)]
    token = [w for w in _split(text) if w]
    n = len(token)
    sizes = np.array(list(map(len, token)), np.int64)
    total = int(sizes.sum())
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in token], np.int64)
    upto = np.concatenate(([0], np.cumsum(sizes)))
    grams = ids
    for k in range(2, 11):
        if n < k:
            out += [0.0] * (k in TOP_NGRAMS or k in DUPLICATE_NGRAMS)
            continue
        _, grams, counts = np.unique(grams[: n - k + 1] * (len(number) + 1) + ids[k - 1 :], return_inverse=True, return_counts=True)
        if k in TOP_NGRAMS:
            most = counts.max()
            chars = (upto[k:] - upto[:-k])[counts[grams] == most].max()
            out.append(float(most * chars / total) if most > 1 else 0.0)
        elif k in DUPLICATE_NGRAMS:
            start = np.flatnonzero(counts[grams] > 1)
            steps = np.zeros(n + 1, np.int64)
            np.add.at(steps, start, 1)
            np.add.at(steps, start + k, -1)
            out.append(float(sizes[np.cumsum(steps[:-1]) > 0].sum() / total))
    return out


def _split(text: str) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return text.split(" ")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [repetition_shares(t) for t in batch.column(1).to_pylist()]
        columns = list(zip(*rows)) if rows else [[]] * (len(REPETITION) - 1)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, pa.float64()) for c in columns)], names=REPETITION)


def repetition(df: DataFrame) -> DataFrame:
    """REPETITION of every document (doc_id, text)."""
    schema = "doc_id long, " + ", ".join(f"{c} double" for c in REPETITION[1:])
    return df.select("doc_id", "text").mapInArrow(_measure, schema)


def repetitive(lines_share: float = 0.30, chars_share: float = 0.20, top: dict[int, float] = TOP_NGRAMS, duplicate: dict[int, float] = DUPLICATE_NGRAMS) -> Column:
    """True for rows of repetition() that break a rule."""
    broken = (F.col("dup_lines") > lines_share) | (F.col("dup_paragraphs") > lines_share) | (F.col("dup_line_chars") > chars_share) | (F.col("dup_paragraph_chars") > chars_share)
    for name, limits in (("top", top), ("dup", duplicate)):
        for n, limit in limits.items():
            broken |= F.col(f"{name}_{n}") > limit
    return broken


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def low_quality(
    text: Column,
    min_words: int = 50,
    max_words: int = 100_000,
    min_mean: float = 3,
    max_mean: float = 10,
    symbols: float = 0.1,
    bullets: float = 0.9,
    ellipses: float = 0.3,
    alphabetic: float = 0.8,
    stop_words: int = 2,
) -> Column:
    """True if a text breaks a rule on words, symbols, bullets, ellipses or stop words; null texts do."""
    w, ln = words(text), lines(text)
    n, n_lines = F.size(w), F.size(ln)
    chars = F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    mean = _ratio(chars, n)
    marks = F.greatest(F.regexp_count(text, F.lit("#")), F.regexp_count(text, F.lit(r"\.\.\.|…")))
    broken = (
        (n < min_words)
        | (n > max_words)
        | (mean < min_mean)
        | (mean > max_mean)
        | (_ratio(marks, n) > symbols)
        | (_ratio(F.size(F.filter(ln, lambda x: x.rlike(r"^[•‣\-*]"))), n_lines) > bullets)
        | (_ratio(F.size(F.filter(ln, lambda x: x.rlike(r"(?:\.\.\.|…)$"))), n_lines) > ellipses)
        | (_ratio(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))), n) < alphabetic)
        | (F.size(F.array_intersect(F.transform(w, F.lower), F.array(*map(F.lit, STOP_WORDS)))) < stop_words)
    )
    return F.coalesce(broken, F.lit(True))


def c4_text(text: Column, min_line_words: int = 3) -> Column:
    """The text without short lines, lines with javascript or policy phrases, and citation marks; null stays null."""
    plain = F.regexp_replace(text, r"\[\d*\]|\[edit\]|\[citation needed\]", "")

    def keep(line: Column) -> Column:
        low = F.lower(line)
        return (F.size(words(line)) >= min_line_words) & ~low.contains("javascript") & ~low.rlike(POLICY)

    return F.array_join(F.filter(lines(plain), keep), "\n")


def c4_bad(text: Column, rewritten: Column, min_sentences: int = 5) -> Column:
    """True for texts with filler or code, or with too few sentences after rewriting; null texts are bad."""
    low = F.lower(text)
    sentences = F.regexp_count(rewritten, F.lit(r"[.!?]+(?:[ \t\n\x0B\f\r]|$)"))
    return F.coalesce(low.contains("lorem ipsum") | text.contains("{") | (sentences < min_sentences), F.lit(True))


def fineweb_bad(text: Column, ended: float = 0.12, short: float = 0.67, short_chars: int = 30, repeated: float = 0.1) -> Column:
    """True if too few lines end in punctuation, too many are short, or too many characters stand in repeated lines."""
    ln = lines(text)
    n = F.size(ln)
    total = F.aggregate(ln, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    once = F.aggregate(F.array_distinct(ln), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    end = _ratio(F.size(F.filter(ln, lambda x: x.rlike(r"[.!?\"'”]$"))), n)
    few = _ratio(F.size(F.filter(ln, lambda x: F.length(x) < short_chars)), n)
    return F.coalesce((n == 0) | (end <= ended) | (few >= short) | (_ratio(total - once, total) >= repeated), F.lit(True))


def cascade(df: DataFrame, language: Column, languages: list[str]) -> DataFrame:
    """doc_id, text after the line rules, and reject_stage: the first failing stage, null for survivors.

    df: (doc_id, text, ...). Stages in order: language, repetition, quality, c4, fineweb.
    """
    marked = df.select("doc_id", F.col("text").alias("original"), F.lower(F.substring_index(language, "-", 1)).isin(languages).alias("spoken"))
    shares = marked.select("doc_id", F.col("original").alias("text"), "spoken")
    measured = shares.mapInArrow(_with_shares, "doc_id long, text string, spoken boolean, repetitive boolean")
    rewritten = measured.withColumn("rewritten", c4_text(F.col("text")))
    stage = first_failing(
        [
            ("language", ~F.coalesce("spoken", F.lit(False))),
            ("repetition", F.col("repetitive")),
            ("quality", low_quality(F.col("text"))),
            ("c4", c4_bad(F.col("text"), F.col("rewritten"))),
            ("fineweb", fineweb_bad(F.col("rewritten"))),
        ]
    )
    return rewritten.select("doc_id", F.col("rewritten").alias("text"), stage.alias("reject_stage"))


def _with_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bad = []
        for text, spoken in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            # the costly rule only where an earlier stage hasn't decided
            bad.append(bool(spoken) and _breaks(repetition_shares(text)))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2), pa.array(bad, pa.bool_())], names=["doc_id", "text", "spoken", "repetitive"])


def _breaks(shares: list[float]) -> bool:
    limits = [0.30, 0.20, 0.30, 0.20, *TOP_NGRAMS.values(), *DUPLICATE_NGRAMS.values()]
    return any(s > limit for s, limit in zip(shares, limits))
