"""Long texts cut into segments of whole sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule.
ABBREVIATIONS = frozenset("Mr. Ms. Mrs. Dr. Prof. Rev. U.S.A. U.K. E.U. U.N. D.C. e.g. i.e. etc. viz. vs. a.m. p.m. Fig. Eq.".split())
CONNECTIVES = ("however", "therefore", "thus", "in contrast", "for example", "in addition", "furthermore", "on the other hand", "in conclusion")
MIN_WORDS, MAX_WORDS = 500, 1000

_INITIALS = re.compile(r"(?:[A-Z]\.){2,}$")
_WORD = re.compile(r"\b[\w-]+\b")
_BEFORE_CONNECTIVE = re.compile(r"(?<=\.)\s+(?=(?:" + "|".join(CONNECTIVES) + "))", re.IGNORECASE)


def words_in(text: str) -> int:
    """Words of a text; a hyphenated word is one."""
    return len(_WORD.findall(text.lower()))


def sentences(text: str) -> list[str]:
    """Sentences of a text, white space collapsed.

    A sentence ends with a token that ends in . ? or !, unless the token is an
    abbreviation, initials, or one character and a full stop. What is left at
    the end is a sentence too.
    """
    out, at, tokens = [], 0, text.split()
    for i, token in enumerate(tokens):
        if token[-1] not in ".?!" or token in ABBREVIATIONS or _INITIALS.match(token) or (len(token) == 2 and token[1] == "."):
            continue
        out.append(" ".join(tokens[at : i + 1]))
        at = i + 1
    if at < len(tokens):
        out.append(" ".join(tokens[at:]))
    return out


def segments(text: str | None, low: int = MIN_WORDS, high: int = MAX_WORDS) -> list[str]:
    """Segments of about low to high words; every word of the text is in exactly one.

    Sentences are packed up to high words; one that overflows is still taken
    while the segment has fewer than low. A segment beyond high is cut before
    connectives, and pieces shorter than low join the one before. Null and
    blank texts have no segments.
    """
    packed: list[str] = []
    current: list[str] = []
    size = 0
    for s in sentences(text or ""):
        n = words_in(s)
        if current and size + n > high and size >= low:
            packed.append(" ".join(current))
            current, size = [], 0
        current.append(s)
        size += n
    if current:
        packed.append(" ".join(current))
    out: list[str] = []
    for segment in packed:
        pieces = _BEFORE_CONNECTIVE.split(segment) if words_in(segment) > high else [segment]
        for piece in pieces:
            if out and (words_in(piece) < low or (len(pieces) > 1 and words_in(out[-1]) + words_in(piece) <= high and piece is not pieces[0])):
                out[-1] = f"{out[-1]} {piece}"
            else:
                out.append(piece)
    return out


def explode_segments(df: DataFrame, low: int = MIN_WORDS, high: int = MAX_WORDS) -> DataFrame:
    """(doc_id, seq, segment, words) of documents (doc_id, text); seq counts from 0."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, i, s, words_in(s)) for d, t in zip(pdf["doc_id"], pdf["text"]) for i, s in enumerate(segments(t, low, high))]
            yield pd.DataFrame(rows, columns=["doc_id", "seq", "segment", "words"])

    return df.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(cut, "doc_id long, seq int, segment string, words long")


def explode_sentences(df: DataFrame) -> DataFrame:
    """(doc_id, seq, sentence) of documents (doc_id, text)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, i, s) for d, t in zip(pdf["doc_id"], pdf["text"]) for i, s in enumerate(sentences(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "seq", "sentence"])

    return df.select("doc_id", "text").where(F.col("text").isNotNull()).mapInPandas(cut, "doc_id long, seq int, sentence string")
