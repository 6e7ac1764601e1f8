"""Text functions as native expressions. Null handling is stated per function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, spelled out because engines differ in what \s holds.
WS = r"[ \t\n\x0B\f\r]"

# Fixed table: Latin letters and the ASCII letter that stands for each; ß, æ and œ become two.
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ "
FOLD_TO = "aaaaaaceeeeiiiinoooooouuuuyy "

_KEPT = "abcdefghijklmnopqrstuvwxyz0123456789 \t\n\x0b\x0c\r,.!?'"
#: ASCII characters that clean_text drops.
_DROPPED = "".join(chr(c) for c in range(1, 128) if chr(c) not in _KEPT)

#: Words at most of a text that clean_text empties.
SHORT_WORDS = 4


def fold_ascii(text: Column) -> Column:
    """Lower-case Latin letters with marks as plain letters; other scripts stay. Null stays null."""
    for long, short in (("ß", "ss"), ("æ", "ae"), ("œ", "oe")):
        text = F.replace(text, F.lit(long), F.lit(short))
    return F.translate(text, FOLD_FROM, FOLD_TO)


def clean_text(text: Column, short_words: int = SHORT_WORDS) -> Column:
    """Corpus cleaning: lower case, folded, without links and other characters than a-z 0-9 , . ! ? '.

    White space is collapsed; null and texts of at most short_words words give ''.
    """
    plain = fold_ascii(F.lower(F.coalesce(text, F.lit(""))))
    plain = F.regexp_replace(plain, r"http[^ \t\n\x0B\f\r]+", "")
    # a class of everything else would be tested for every character; deleting by table is much faster
    plain = F.translate(F.regexp_replace(plain, r"[^\x01-\x7F]+", ""), _DROPPED, "")
    plain = F.trim(F.regexp_replace(plain, WS + "+", " "))
    # one use of plain, so that it is computed once
    return F.regexp_extract(plain, rf"(?s)^(?:[^ ]+ ){{{short_words}}}[^ ].*", 0)


def clean_whitespace(text: Column) -> Column:
    """Runs of white space as one blank, ends trimmed; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WS + "+", " "))


def flatten_newlines(text: Column) -> Column:
    """Every line feed as one blank; null stays null."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def clean_filename(name: Column) -> Column:
    """Letters, digits, '.' and '_' of a name; null stays null."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}._]", "")


def truncate_text(text: Column, limit: int) -> Column:
    """Whole text if it has at most limit characters, else its whole sentences (up to '.') within limit, trimmed."""
    return F.when(F.length(text) <= limit, text).otherwise(F.trim(F.regexp_extract(F.substring(text, 1, limit), r"(?s)^.*\.", 0)))


def word_count(text: Column) -> Column:
    """Runs of letters, digits and '_', joined by hyphens to one word; null counts 0."""
    return F.coalesce(F.regexp_count(F.lower(text), F.lit(r"[\p{L}\p{N}_]+(?:-+[\p{L}\p{N}_]+)*")), F.lit(0)).cast("long")


def score_of_reply(reply: Column) -> Column:
    """A judge's reply as a score 0-5; anything else, null included, is -1."""
    trimmed = F.trim(reply)
    number = F.when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast("int"))
    return F.when(number.between(0, 5), number).otherwise(F.lit(-1))


def numeric(text: Column) -> Column:
    """A number, or null if text is none; NaN counts as none."""
    number = text.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to 2 places; 0 if whole is 0."""
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0)), 2)
