"""Extensions: masking of addresses, texts of HTML, word-like token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_addresses(text: Column) -> Column:
    """E-mail and IPv4 addresses replaced by fixed examples; null stays null."""
    text = F.regexp_replace(text, r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "email@example.com")
    return F.regexp_replace(text, r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", "192.0.2.1")


def token_count(text: Column) -> Column:
    """Word-like tokens: runs of letters and digits, and every other visible character; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\x0B\f\r]")), F.lit(0)).cast("long")


def html_text(html: Column) -> Column:
    """Text of an HTML string: scripts, styles and tags removed, blanks collapsed; null stays null."""
    plain = F.regexp_replace(html, r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    plain = F.regexp_replace(plain, r"(?s)<[^>]*>", " ")
    for mark, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(mark), F.lit(char))
    return F.trim(F.regexp_replace(plain, r"[ \t\n\x0B\f\r]+", " "))
