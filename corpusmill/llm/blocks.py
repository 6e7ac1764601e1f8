"""Texts read once: blocks of documents with their units and numbered words.

What the rounds of ``lexicon`` and the pages of ``spam`` need of a text, its
units, words and all that is known of a unit without a lexicon, is found once
and kept as a table with a row per block of documents. Words are numbered per
block, so every later round works on arrays and looks a block's distinct words
up only once. A block ends with the document that brings it to BLOCK_WORDS
words; a document is never parted, and none is left out.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import units
from corpusmill.llm.langid import primary_label
from corpusmill.scratch import materialize

#: Words from which a block is full, and blocks that a task of a join reads.
BLOCK_WORDS, TASK_BLOCKS = 500_000, 2

#: words: the distinct words, whose places are their numbers; of_text: the numbers that a function gives for every text. Packed: numbers, the words in order; of every document its units; of every
#: unit its words, characters, visible characters, traits, and whether it is the first of its kind in the document.
SCHEMA = "block long, words array<string>, doc_ids array<long>, langs array<string>, chars array<long>, of_text array<long>, numbers binary, doc_units binary, unit_words binary, unit_chars binary, unit_visible binary, unit_kind binary, unit_bits binary, unit_first binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_LISTS = {"words": pa.list_(pa.string()), "doc_ids": pa.list_(pa.int64()), "langs": pa.list_(pa.string()), "chars": pa.list_(pa.int64()), "of_text": pa.list_(pa.int64())}


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class _Writer:
    """The block that documents are being added to."""

    def __init__(self, of_text: Callable[[str], list[int]] | None) -> None:
        self.words, self.count = _Numbers(), of_text
        self.doc_ids, self.langs, self.chars, self.of_text = [], [], [], []
        self.numbers, self.doc_units = array("i"), array("i")
        self.unit_words, self.unit_chars, self.unit_visible = array("i"), array("i"), array("i")
        self.unit_kind, self.unit_bits, self.unit_first = array("B"), array("B"), array("B")

    def add(self, doc_id: int | None, text: str, lang: str | None) -> None:
        known = set()
        parts = units.units_of(text)
        for unit in parts:
            words = units.tokens_of(unit)
            kind, bits = units.traits(unit, words)
            self.numbers.extend(map(self.words.__getitem__, words))
            self.unit_words.append(len(words))
            self.unit_chars.append(len(unit))
            self.unit_visible.append(len(unit.strip()))
            self.unit_kind.append(kind)
            self.unit_bits.append(bits)
            self.unit_first.append(unit not in known)
            known.add(unit)
        self.doc_units.append(len(parts))
        self.doc_ids.append(doc_id)
        self.langs.append(lang)
        self.chars.append(len(text))
        if self.count:
            self.of_text += self.count(text)

    def row(self, block: int) -> pa.RecordBatch:
        values = {"block": block, "words": list(self.words)} | {c: getattr(self, c) for c in NAMES[2:]}
        columns = [pa.array([v if c in _LISTS or c == "block" else v.tobytes()], _LISTS.get(c, pa.int64() if c == "block" else pa.binary())) for c, v in values.items()]
        return pa.RecordBatch.from_arrays(columns, names=NAMES)


def _read(block_words: int, of_text: Callable[[str], list[int]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        writer = _Writer(of_text)
        for batch in batches:
            for doc in zip(*(batch.column(c).to_pylist() for c in range(3))):
                writer.add(*doc)
                if len(writer.numbers) >= block_words:
                    yield writer.row(block)
                    block, writer = block + 1, _Writer(of_text)
        if writer.doc_ids:
            yield writer.row(block)

    return run


def read(docs: DataFrame, declared_only: bool = False, block_words: int = BLOCK_WORDS, of_text: Callable[[str], list[int]] | None = None) -> DataFrame:
    """The blocks of docs (doc_id, text, lang) with text, as a table; lang is null unless it is a declared language.

    declared_only leaves out the documents without a declared language; of_text
    gives as many numbers for every text, which are kept.
    """
    lang = primary_label(F.col("lang"))
    told = docs.select("doc_id", "text", F.when(lang.rlike("^[a-z]{2,3}$"), lang).alias("lang")).where(F.col("text").isNotNull())  # two- or three-letter codes
    if declared_only:
        told = told.where(F.col("lang").isNotNull())
    return materialize(told.mapInArrow(_read(block_words, of_text), SCHEMA), "blocks")


class Block:
    """The arrays of a row of the table, of the columns that were selected; doc_of, unit_of: the document of every unit and the unit of every word."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        for name in set(NAMES) & set(batch.schema.names):
            value = batch.column(name)[row]
            if name in ("words", "doc_ids"):
                setattr(self, name, value.values)
            elif name == "block" or name in _LISTS:
                setattr(self, name, value.as_py())
            else:
                small = name in ("unit_kind", "unit_bits", "unit_first")
                setattr(self, name, np.frombuffer(value.as_buffer(), np.uint8 if small else np.int32))
        self.doc_of = np.repeat(np.arange(len(self.doc_units)), self.doc_units)
        self.unit_of = np.repeat(np.arange(len(self.unit_words)), self.unit_words)

    def per_unit(self, values: np.ndarray) -> np.ndarray:
        """Sums over the words of every unit of the values of distinct words."""
        return np.bincount(self.unit_of, values[self.numbers], len(self.unit_words))

    def per_doc(self, of_units: np.ndarray) -> np.ndarray:
        """Sums over the units of every document."""
        return np.bincount(self.doc_of, of_units, len(self.doc_units))

    def among(self, words: frozenset[str]) -> np.ndarray:
        """1 for the distinct words that are among words, else 0."""
        return np.fromiter(map(words.__contains__, self.words.to_pylist()), np.float64, len(self.words))

    def kinds(self, lexicon) -> np.ndarray:
        """What the units are with a lexicon; see units.judge."""
        return units.judge_all(self.unit_kind, self.unit_bits, self.unit_words, self.per_unit(self.among(lexicon.clause)), self.per_unit(self.among(lexicon.selling)))

    def doc_words(self) -> np.ndarray:
        """Where the words of every document begin in numbers, and, last, where they all end."""
        return np.concatenate(([0], np.cumsum(self.per_doc(self.unit_words)))).astype(np.int64)


def of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    """(batch, row, block) of every row of Arrow batches of the table."""
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch, row, Block(batch, row)
