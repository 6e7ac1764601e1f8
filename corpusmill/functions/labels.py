"""Label lines ``__label__1 text``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "__label__"


def label_line(label: Column, text: Column) -> Column:
    """A label line; line ends inside the text become blanks, null text is empty."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]+", " ")
    return F.trim(F.concat(F.lit(PREFIX), label.cast("string"), F.lit(" "), flat))


def strip_label(label: Column) -> Column:
    """The label without its prefix."""
    return F.replace(label, F.lit(PREFIX), F.lit(""))
