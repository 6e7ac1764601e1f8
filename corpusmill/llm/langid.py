"""Languages of texts and of their lines, by word-first backoff.

A known word is scored by its log frequency in each language; an unknown one
falls back to its character 5-grams, then 4-, 3- and 2-grams, whichever are
known first. Texts in Han, kana or Hangul are told apart by script. The model
is fitted on a bounded sample of rows with a declared language, once more after
that sample has been relabelled by the first fit (declared labels are partly
wrong), and is small enough to ship to every task; scoring covers every line of
every text and shuffles nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.units import CAMEL

#: Bounds of the fit: sampled rows of a declared language, and words kept of it.
SAMPLE_ROWS = 800
VOCABULARY = 8000
#: Longest text of the sample; longer ones are scored like all others, but not fitted on.
SAMPLE_CHARS = 20_000
#: Words from which a language is learned, and the share of its words that must be its own: TIMES as frequent as in any other.
LEAST_WORDS, OWN, TIMES = 50, 0.25, 3.0
#: A word counts for a language by at most so many nats against the best one.
CLIP = 7.0
#: A line has a language if its best two languages lie MARGIN nats apart and it has TELLING known words,
#: a share TELLING_SHARE of all its words, that each tell languages apart by TELLING_NATS.
MARGIN, TELLING, TELLING_SHARE, TELLING_NATS = 5.0, 2, 0.15, 1.0
#: A word tells languages apart only if it stands in so many texts of the sample: names of one text do not.
TELLING_TEXTS = 3
#: A line, or a text of the sample, with so large a share of words glued to symbols is unreadable.
UNREADABLE = 0.2
#: Shares of a text's words, and of its characters, in lines with a language, below which the text has none.
COVERED, COVERED_CHARS = 0.25, 0.2
#: A Han, kana or Hangul character counts as this many words.
CHAR_WORDS = 0.6
#: A line of another language needs so many words or Han characters.
LINE_WORDS, LINE_CHARS = 5, 10
#: Declared labels that say nothing.
NO_LABEL = ("", "und", "unknown")

_SCRIPTS = {"zh": "㐀-䶿一-鿿", "ja": "぀-ヿ", "ko": "가-힯"}
_CJK = "".join(_SCRIPTS.values())
#: Symbols that don't touch the words of readable texts, but stand all over wrongly decoded ones.
_SYMBOLS = "\ufffd©¤¥¦¬±¼½¾€™"
_TOKEN = re.compile(rf"\n|\S*[{_SYMBOLS}]\S*|[^\W\d_{_CJK}{_SYMBOLS}]+|[{_CJK}]+")
_GLUED, _LETTER = re.compile(f"[{_SYMBOLS}]"), re.compile(r"[^\W\d_]")
#: Stands for every word glued to a symbol.
_NO_WORD = "\ufffd"
_KANA, _HANGUL = re.compile(f"[{_SCRIPTS['ja']}]"), re.compile(f"[{_SCRIPTS['ko']}]")

SEGMENTS = "id string, seg_no long, lang string, confidence double, words double"


def primary_label(label: Column) -> Column:
    """The part of a declared label before '-' or '_' in lower case; null if it says nothing."""
    part = F.lower(F.trim(F.regexp_extract(label, r"^([^\-_]*)", 1)))
    return F.when(~part.isin(*NO_LABEL), part)


@dataclass
class LanguageModel:
    """Log frequencies of words and character n-grams by language."""

    languages: list[str]
    words: dict[str, np.ndarray]
    grams: dict[str, np.ndarray]
    #: words that may tell languages apart; all if None
    telling: frozenset[str] | None = None
    _cache: dict = field(default_factory=dict, repr=False)

    def score(self, word: str) -> np.ndarray:
        """Nats of every language against the best one for a lower-case word, clipped; zeros if nothing is known."""
        known = self.words.get(word)
        if known is not None:
            return known
        framed = f"^{word}$"
        for n in (5, 4, 3, 2):
            found = [g for i in range(len(framed) - n + 1) if (g := self.grams.get(framed[i : i + n])) is not None]
            if found:
                mean = np.mean(found, axis=0) * 0.5
                return mean - mean.max()
        return np.zeros(len(self.languages), np.float32)

    @staticmethod
    def fit(counts: dict[str, dict[str, int]], docs: dict[str, dict[str, int]] | None = None) -> LanguageModel:
        """counts: language -> word -> occurrences; docs: the texts with the word, by which wrongly declared languages are told."""
        languages = sorted(lang for lang, c in counts.items() if sum(c.values()) >= LEAST_WORDS)
        if docs is not None:
            languages = _distinct(languages, counts, docs)
        words: dict[str, list[float]] = defaultdict(lambda: [0.0] * len(languages))
        grams: dict[str, list[float]] = defaultdict(lambda: [0.0] * len(languages))
        for k, lang in enumerate(languages):
            for w, n in counts[lang].items():
                words[w][k] += n
                framed, weight = f"^{w}$", n**0.5
                for size in (2, 3, 4, 5):
                    for i in range(len(framed) - size + 1):
                        grams[framed[i : i + size]][k] += weight
        telling = None if docs is None else frozenset(w for lang in languages for w, n in docs[lang].items() if n >= TELLING_TEXTS)
        return LanguageModel(languages, _log_ratios(words, 1.0, 0), _log_ratios(grams, 1.0, 3), telling)


def _distinct(languages: list[str], counts: dict[str, dict[str, int]], docs: dict[str, dict[str, int]]) -> list[str]:
    """The languages with words of their own.

    A label that only stands on texts of other languages by mistake shares its
    words with those: of its occurrences of words of several texts, OWN must be
    of words at least TIMES as frequent as in any language with more words. So
    a rare language is learned, however small its share.
    """
    total = {lang: sum(counts[lang].values()) for lang in languages}
    rates: dict[str, float] = {}
    kept = []
    for lang in sorted(languages, key=lambda x: (-total[x], x)):
        common = {w: n for w, n in counts[lang].items() if docs[lang].get(w, 0) > 1}
        own = sum(n for w, n in common.items() if n / total[lang] >= TIMES * rates.get(w, 0.0))
        if own and own >= OWN * sum(common.values()):
            kept.append(lang)
            for w, n in counts[lang].items():
                rates[w] = max(rates.get(w, 0.0), n / total[lang])
    return sorted(kept)


def _log_ratios(table: dict[str, list[float]], alpha: float, least: float) -> dict[str, np.ndarray]:
    if not table:
        return {}
    keys = list(table)
    n = np.array([table[k] for k in keys], np.float64)
    keep = n.sum(axis=1) >= least
    log = np.log((n + alpha * n.sum(axis=0) / n.sum(axis=0).max()) / n.sum(axis=0).clip(1))
    log = np.maximum(log - log.max(axis=1, keepdims=True), -CLIP).astype(np.float32)
    return {k: v for k, v, ok in zip(keys, log, keep) if ok}


class _Scorer:
    """Languages of lines and texts, many texts at a time."""

    CACHED = 300_000

    def __init__(self, model: LanguageModel):
        self.model, self.size = model, len(model.languages)
        self.names = np.array([*model.languages, *_SCRIPTS], object)
        self.clear()

    def clear(self) -> None:
        # 0: line end, 1: a word glued to symbols
        self.number, self.used = {"\n": 0, _NO_WORD: 1}, 2
        self.scores = np.zeros((1024, self.size + 3), np.float32)
        self.weight = np.zeros(1024, np.float32)
        self.chars = np.zeros(1024, np.int32)
        self.telling = np.zeros(1024, bool)
        self.weight[1] = 1

    def add(self, token: str) -> int:
        if len(token) > 1 and _GLUED.search(token):
            # one number for all of them, or none for symbols without letters
            self.number[token] = at = self.number[_NO_WORD] if _LETTER.search(token) else -1
            return at
        at = self.number[token] = self.used
        self.used += 1
        if at >= len(self.weight):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.weight, self.chars, self.telling = (np.concatenate([x, np.zeros_like(x)]) for x in (self.weight, self.chars, self.telling))
        if re.match(f"[{_CJK}]", token):
            lang = "ja" if _KANA.search(token) else "ko" if _HANGUL.search(token) else "zh"
            row = np.full(self.size + 3, -2.0 * len(token), np.float32)
            row[self.size + list(_SCRIPTS).index(lang)] = 0
            self.chars[at], self.weight[at] = len(token), CHAR_WORDS * len(token)
        else:
            row = np.concatenate([self.model.score(token), np.full(3, -CLIP, np.float32)]) if self.size else np.zeros(3, np.float32)
            self.weight[at] = 1
            # single letters and unknown words score, but alone make no language: junk is full of them
            known = token in self.model.words and (self.model.telling is None or token in self.model.telling)
            self.telling[at] = len(token) > 1 and known and np.partition(row, -2)[-2] <= -TELLING_NATS
        self.scores[at] = row
        return at

    def segments(self, ids: list[str], texts: list[str | None]) -> tuple[list, ...]:
        """Columns of SEGMENTS: seg_no -1 for each text with a language, then its lines in another one."""
        if len(self.number) > self.CACHED:
            self.clear()
        number, add = self.number, self.add
        stream: list[int] = []
        owner: list[int] = []
        sizes: list[int] = []
        for row, text in enumerate(texts):
            if not text:
                continue
            if "#" in text:  # words run together in tags
                text = CAMEL.sub(" ", text)
            tokens = _TOKEN.findall(text.lower())
            stream += [n for t in tokens if (n := number[t] if t in number else add(t)) >= 0]
            stream.append(0)
            lines = [len(x) - x.count(" ") for x in text.split("\n")]
            sizes += lines
            owner += [row] * len(lines)
        if not stream:
            return [], [], [], [], []
        tok = np.array(stream, np.int64)
        ends = np.flatnonzero(tok == 0)
        starts = np.concatenate(([0], ends[:-1] + 1))
        nonzero = tok != 0
        # sums over lines by differences of cumulative sums: empty lines come out as zeros
        def per_line(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
            return upto[ends] - upto[starts]

        score = per_line(self.scores[tok])
        words = per_line(self.weight[tok] * nonzero)
        chars = per_line(self.chars[tok])
        telling = per_line(self.telling[tok] & nonzero)
        glued = per_line(tok == 1)
        best = np.argmax(score, axis=1)
        two = np.partition(score, -2, axis=1)
        margin = two[:, -1] - two[:, -2]
        by_words = (telling >= TELLING) & (telling >= TELLING_SHARE * words)
        by_script = (best >= self.size) & (chars >= 4)
        sure = (margin >= MARGIN) & (by_words | by_script) & (glued <= UNREADABLE * words)
        owner_ = np.array(owner)
        first_line = np.concatenate(([0], np.flatnonzero(np.diff(owner_)) + 1))
        line_no = np.arange(len(owner_)) - np.repeat(first_line, np.diff(np.concatenate((first_line, [len(owner_)]))))
        votes = np.zeros((len(texts), self.size + 3))
        np.add.at(votes, (owner_[sure], best[sure]), words[sure])
        total = np.bincount(owner_, words, len(texts))
        main = np.argmax(votes, axis=1)
        spoken = votes.sum(axis=1)
        size = np.array(sizes, np.float64)
        visible, told = np.bincount(owner_, size, len(texts)), np.bincount(owner_[sure], size[sure], len(texts))
        has = (spoken > 0) & (spoken >= COVERED * total) & (told >= COVERED_CHARS * visible)
        share = votes.max(axis=1) / np.maximum(spoken, 1e-9)
        other = sure & has[owner_] & (best != main[owner_]) & ((words - CHAR_WORDS * chars >= LINE_WORDS) | (chars >= LINE_CHARS))
        rows, at = np.flatnonzero(has), np.flatnonzero(other)
        confidence = 1 / (1 + np.exp(-np.minimum(margin, 50)))
        return (
            [ids[r] for r in rows] + [ids[owner_[i]] for i in at],
            [-1] * len(rows) + line_no[at].tolist(),
            self.names[main[rows]].tolist() + self.names[best[at]].tolist(),
            share[rows].tolist() + confidence[at].tolist(),
            total[rows].tolist() + words[at].tolist(),
        )


def _label(model: LanguageModel):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                columns = scorer.segments(part.column(0).to_pylist(), part.column(1).to_pylist())
                types = (pa.string(), pa.int64(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "seg_no", "lang", "confidence", "words"])

    return label


def segments(texts: DataFrame, model: LanguageModel) -> DataFrame:
    """SEGMENTS of texts (id string, text).

    seg_no -1: the language of most of the text, with the share of its
    recognised words that is in it. seg_no >= 0: a line (cut at LF, numbered
    from 0 with blank lines) of at least LINE_WORDS words or LINE_CHARS Han
    characters in another language, with its posterior. Null and empty texts
    and texts in no language have no rows; repeated ids have repeated rows.
    """
    return texts.select("id", "text").mapInArrow(_label(model), SEGMENTS)


def _word_counts(labelled: DataFrame) -> tuple[dict[str, dict[str, int]], dict[str, dict[str, int]]]:
    """(occurrences, texts) of the VOCABULARY most frequent words of each language of labelled (id, text, lang)."""
    # the languages of the scripts need no words, and other words in their texts are not theirs
    labelled = labelled.where(~F.col("lang").isin(*_SCRIPTS))
    words = labelled.select("lang", "id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]]+"), F.lit(0))).alias("word"))
    in_text = words.groupBy("lang", "word", "id").agg(F.count(F.lit(1)).alias("n"))
    counted = in_text.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    out: dict[str, dict[str, int]] = defaultdict(dict)
    docs: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= VOCABULARY).collect():  # languages x VOCABULARY
        out[r.lang][r.word] = r.n
        docs[r.lang][r.word] = r.docs
    return out, docs


def fit(texts: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from texts (id string, text, label).

    Fitted on about sample_rows rows of every declared two-letter language,
    chosen by a hash of id. Rows without label or text are not used.
    """
    named = texts.withColumn("lang", primary_label(F.col("label"))).where(F.col("lang").rlike("^[a-z]{2}$"))
    sizes = dict(named.groupBy("lang").count().collect())  # two-letter codes: at most 676; texts are not read for it
    rows = named.select("id", "text", "lang").where(F.col("text").isNotNull())
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    glued = F.regexp_count("text", F.lit(rf"\p{{L}}[{_SYMBOLS}]|[{_SYMBOLS}]\p{{L}}")) > UNREADABLE * F.regexp_count("text", F.lit(r"\S+"))
    chosen = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000
    # the costly condition last: it is tested on what the others leave
    sample = rows.where(chosen).where(F.length("text") <= SAMPLE_CHARS).where(~glued).persist()
    try:
        first = LanguageModel.fit(*_word_counts(sample))
        again = segments(sample, first).where("seg_no = -1").select("id", "lang", "confidence").where("confidence > 0.8").dropDuplicates(["id"])
        return LanguageModel.fit(*_word_counts(sample.drop("lang").join(again, "id")))
    finally:
        sample.unpersist()
