"""Words of sentences and words of keyword pages, learned from the corpus.

Nothing here knows a language. Units that end with a stop are taken for
sentences and all others for something else; the log-odds of a word between the
two tell the words that sentences are made of. Both are often wrong (sentences
without stops, items with stops), so the units are told apart once more by
those words, and the words are learned again. Han, kana and other scripts
without blanks count by characters.

Selling words are found by what they do: on pages that are mostly not sentences
and mostly covered by repeated runs of words (the pages' suffix automata), they
stand many times as often as on other pages of the same declared language, while
the words of any subject stand on both.

Fitted on all documents with a declared language, whose texts are read once
(``blocks``). All counts are of the whole corpus and stay distributed; only the
words that are found reach the driver, each of which stands in a fixed share of
a language's documents or pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import blocks, units
from corpusmill.scratch import discard, materialize

#: Words of a unit from which it may be a sentence, units of a word from which it is known, and bound of its log-odds.
SENTENCE_WORDS, KNOWN_UNITS, CLIP = 5, 5, 3.0
#: Mean log-odds from which a unit is a sentence in the second round, and below which it is none.
SURE, NONE = 0.5, 0.0
#: A word is one that sentences are made of from these log-odds on, if it stands in so large a share of a language's documents.
CLAUSE_ODDS, CLAUSE_DOCS = 1.3, 0.06
#: Share of a page that isn't sentences, and of the words there that repeated runs cover, from which it tells selling words.
BARE, COVERED, BARE_WORDS = 0.5, 0.25, 10
#: A selling word stands on so many such pages of a language, a share of them, and so many times as often as on its other pages.
SELLING_PAGES, SELLING_SHARE, SELLING_TIMES = 3, 0.08, 8.0


@dataclass(frozen=True)
class Lexicon:
    """clause: words that sentences are made of; selling: words of search phrases."""

    clause: frozenset[str]
    selling: frozenset[str]


def _firsts(keys: np.ndarray) -> np.ndarray:
    """The distinct keys."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def _by_language(block: blocks.Block, lang_of: np.ndarray, **found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(lang, word, counts) of a block; found: per count the documents it was found in and the words, and the documents of all that word '' counts."""
    size = len(block.words)
    words = pa.concat_arrays([block.words, pa.array([""])])
    for lang in sorted({lang for lang in block.langs if lang}):
        own = lang_of == lang
        counts = [np.append(np.bincount(word[own[doc]], minlength=size), own[all_].sum()) for doc, word, all_ in found.values()]
        at = np.flatnonzero(sum(counts))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), words.take(pa.array(at)), *(pa.array(c[at].astype(np.int64)) for c in counts)], names=["lang", "word", *found])


def _told(block: blocks.Block, odds: np.ndarray | None) -> np.ndarray:
    """1 for the units that are taken for sentences, 0 for those taken for none, else -1."""
    n = block.unit_words
    if odds is None:
        stop = block.unit_bits & units.STOP > 0
        told = np.where(stop, np.where(n > SENTENCE_WORDS, 1, -1), 0)
    else:
        mean = block.per_unit(odds) / np.maximum(n, 1)
        told = np.where((n >= SENTENCE_WORDS) & (mean > SURE), 1, np.where((n < SENTENCE_WORDS) | (mean < NONE), 0, -1))
    return np.where(n > 0, told, -1)


#: What _count_words reads of a block.
COUNTED = ("block", "words", "langs", "numbers", "doc_units", "unit_words", "unit_bits", "unit_first")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, sentences, others, docs) of every block's units and documents, equal units of a document once; word '' counts all."""
    for batch, row, block in blocks.of(batches):
        odds = None
        if "known" in batch.schema.names:  # (number, odds) of the block's known words
            known = batch.column("known")[row].values
            odds = np.zeros(len(block.words))
            if known is not None:
                odds[known.field("number").to_numpy()] = known.field("odds").to_numpy()
        size = len(block.words)
        told = _told(block, odds)
        counted = (told >= 0) & (block.unit_first > 0)
        mine = counted[block.unit_of]
        of_unit = _firsts(block.unit_of[mine] * size + block.numbers[mine])  # once a unit
        unit, word = of_unit // max(size, 1), of_unit % max(size, 1)
        of_doc = _firsts(block.doc_of[unit] * size + word)
        kind, doc = told[unit] == 1, block.doc_of[unit]
        with_units = np.flatnonzero(block.per_doc(counted))
        yield from _by_language(
            block,
            np.array(block.langs, object),
            sentences=(doc[kind], word[kind], block.doc_of[counted & (told == 1)]),
            others=(doc[~kind], word[~kind], block.doc_of[counted & (told == 0)]),
            docs=(of_doc // max(size, 1), of_doc % max(size, 1), with_units),
        )


def _learn(table: DataFrame) -> DataFrame:
    """(word, odds, share) of the known words of all blocks, as a table; table: the blocks, with known if units are to be told apart by that."""
    counted = table.select(*COUNTED, *(c for c in table.columns if c == "known")).mapInArrow(_count_words, "lang string, word string, sentences long, others long, docs long").groupBy("lang", "word").agg(F.sum("sentences").alias("a"), F.sum("others").alias("b"), F.sum("docs").alias("docs"))
    counted = materialize(counted, "lexicon-counts")  # read for the languages and for the words
    all_ = counted.where("word = ''").select("lang", (F.col("a") / (F.col("a") + F.col("b"))).alias("usual"), F.col("docs").alias("all_docs"))
    n = F.col("a") + F.col("b")
    by_word = (
        counted.where("word <> ''")
        .join(F.broadcast(all_), "lang")  # a row per language
        .groupBy("word")
        .agg(F.sum("a").alias("a"), F.sum(n * F.col("usual")).alias("expected"), F.sum(n).alias("n"), F.max(F.col("docs") / F.col("all_docs")).alias("share"))
    )
    # log-odds of a word between sentences and other units, against those of its languages' units:
    # a of its n units are sentences; expected would be, if it were any word
    a, expected, units_ = F.col("a"), F.col("expected"), F.col("n")
    odds = F.log((a + 1) / (expected + 1)) - F.log((units_ - a + 1) / (units_ - expected + 1))
    known = by_word.where(units_ >= KNOWN_UNITS).select("word", F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), odds)).alias("odds"), "share")
    learned = materialize(known, "lexicon-odds")
    discard(counted)
    return learned


def _with_known(table: DataFrame, odds: DataFrame) -> DataFrame:
    """The blocks with known, the (number, odds) of their known words: joined by word, so that the words of the corpus are on no single machine."""
    parts = max(table.count() // blocks.TASK_BLOCKS, 1)
    numbered = table.select("block", F.posexplode("words").alias("number", "word"))
    # bounded: as many as a block has distinct words
    known = numbered.join(odds.select("word", "odds"), "word").repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("number", "odds")).alias("known"))
    return table.select(*COUNTED).repartition(parts, "block").join(known, "block", "left")


def _page_words(clause: frozenset[str]):
    """An Arrow function of blocks: (lang, word, bare, other) pages with the word; word '' counts the pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from corpusmill.llm.spam import covered

        lexicon = Lexicon(clause, frozenset())
        for _, _, block in blocks.of(batches):
            size = len(block.words)
            plain = block.kinds(lexicon) != units.SENTENCE
            chars, begin = block.unit_chars, block.doc_words()
            declared = np.array([bool(lang) for lang in block.langs], bool)
            outside = np.repeat(plain, block.unit_words)
            outside_words = block.per_doc(plain * block.unit_words)
            page = declared & (outside_words >= BARE_WORDS) & (block.per_doc(plain * chars) > BARE * block.per_doc(chars))
            telling = np.zeros(len(block.numbers), bool)
            for i in np.flatnonzero(page):
                at = slice(begin[i], begin[i + 1])
                telling[at] = covered(block.numbers[at].tolist()) & outside[at]
                page[i] = telling[at].sum() >= COVERED * outside_words[i]
            doc = block.doc_of[block.unit_of]
            bare, other = (_firsts(doc[at] * size + block.numbers[at]) for at in (page[doc] & telling, ~page[doc]))
            yield from _by_language(
                block,
                np.array(block.langs, object),
                bare=(bare // max(size, 1), bare % max(size, 1), np.flatnonzero(page)),
                other=(other // max(size, 1), other % max(size, 1), np.flatnonzero(~page)),
            )

    return count


def _selling(table: DataFrame, clause: frozenset[str]) -> frozenset[str]:
    counted = table.mapInArrow(_page_words(clause), "lang string, word string, bare long, other long").groupBy("lang", "word").agg(F.sum("bare").alias("bare"), F.sum("other").alias("other"))
    counted = materialize(counted, "lexicon-counts")
    pages = counted.where("word = ''").select("lang", F.col("bare").alias("bare_pages"), F.col("other").alias("other_pages"))
    share, usual = F.col("bare") / F.col("bare_pages"), F.col("other") / F.greatest("other_pages", F.lit(1))
    found = counted.where((F.col("word") != "") & (F.col("bare") >= SELLING_PAGES)).join(F.broadcast(pages), "lang")  # a row per language
    words = found.where((share >= SELLING_SHARE) & (share >= SELLING_TIMES * usual)).select("word").distinct().collect()  # of large shares, so few a language
    discard(counted)
    return frozenset(r.word for r in words if r.word.isalpha() and (len(r.word) > 1 or units.HAN.match(r.word)))


def fit_blocks(table: DataFrame) -> Lexicon:
    """A lexicon of all documents with a declared language in a table of blocks.read."""
    first = _learn(table)
    second = _learn(_with_known(table, first))
    rows = second.where((F.col("odds") >= CLAUSE_ODDS) & (F.col("share") >= CLAUSE_DOCS)).select("word").collect()  # of large shares, so few a language
    clause = frozenset(r.word for r in rows)
    for learned in (first, second):
        discard(learned)
    return Lexicon(clause, _selling(table, clause) - clause)


def fit(docs: DataFrame, block_words: int = blocks.BLOCK_WORDS) -> Lexicon:
    """A lexicon of all docs (doc_id, text, lang) with a declared language and text, whatever their number and length.

    Documents without a declared language or text are not read. Without any,
    the lexicon is empty, and no unit is a sentence.
    """
    table = blocks.read(docs, declared_only=True, block_words=block_words)
    learned = fit_blocks(table)
    discard(table)
    return learned
