"""Evaluation texts that leaked into a corpus, by a positional inverted index.

The index is sharded by documents: a segment is a run of documents with the
positions of every term in it, so it is built without a shuffle and written
once. A search reads the postings of the test terms, takes the rarest term of
every window of MIN_WORDS test words as its anchor, and intersects the
offset-adjusted postings outwards from the anchors, segment by segment. A
segment holds at most SEGMENT_CHARS characters (or one longer document), so no
term, document or item collects an unbounded group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import materialize

#: Consecutive words that count as a leaked passage.
MIN_WORDS = 12
SEGMENT_CHARS = 4_000_000
#: Test words searched for at a time; a larger test set is searched in blocks.
BLOCK_WORDS = 1_000_000
#: Pairs of an anchor's places in a segment and in the items that are compared at a time.
PAIRS = 4_000_000
#: Proximity: this many of an item's RARE rarest terms within SPAN words.
RARE, NEAR, SPAN = 10, 8, 60

_WORD = re.compile(r"[^\W_]+")
_INDEX = "segment long, term string, docs int, places binary, doc_ids array<long>"


def words_of(text: str | None) -> list[str]:
    """Longest runs of letters and digits, in lower case."""
    return "\n".join(_WORD.findall(text)).lower().split("\n") if text and _WORD.search(text) else []


def _postings(segment: int, doc_ids: list[int], lengths: list[int], terms: dict[str, int], stream: list[int]) -> pa.RecordBatch:
    ids, sizes = np.array(stream, np.int64), np.array(lengths, np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(ids)) + doc  # one free place between documents, which no passage crosses
    order = np.argsort(ids, kind="stable")
    term, place, doc = ids[order], places[order], doc[order]
    first = np.ones(len(term), bool)
    first[1:] = term[1:] != term[:-1]
    gaps = place.copy()
    gaps[1:] = np.where(first[1:], place[1:], place[1:] - place[:-1])
    counts = np.bincount(term, minlength=len(terms))
    new_doc = first.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    in_docs = np.bincount(term, weights=new_doc, minlength=len(terms)).astype(np.int32)
    offsets = np.concatenate(([0], np.cumsum(counts) * 4, [4 * len(ids) + 4 * len(sizes)])).astype(np.int32)
    starts = (np.cumsum(sizes) - sizes + np.arange(len(sizes))).astype(np.uint32)
    data = gaps.astype(np.uint32).tobytes() + starts.tobytes()
    n = len(terms) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, segment), pa.int64()),
            pa.array([*terms, None], pa.string()),
            pa.array(np.append(in_docs, len(sizes)), pa.int32()),
            pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]),
            pa.array([None] * len(terms) + [doc_ids], pa.list_(pa.int64())),
        ],
        names=["segment", "term", "docs", "places", "doc_ids"],
    )


def _segments(segment_chars: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        terms: dict[str, int] = {}
        doc_ids, lengths, stream, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if not words:
                    continue
                stream += [terms.setdefault(w, len(terms)) for w in words]
                doc_ids.append(doc_id)
                lengths.append(len(words))
                size += len(text)
                if size >= segment_chars:
                    yield _postings(task << 32 | made, doc_ids, lengths, terms, stream)
                    made += 1
                    terms, doc_ids, lengths, stream, size = {}, [], [], [], 0
        if doc_ids:
            yield _postings(task << 32 | made, doc_ids, lengths, terms, stream)

    return index


def build_index(docs: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """The index of docs (doc_id, text) as a table: one row per segment and term.

    term null holds the segment's documents and where each begins. Null ids,
    null texts and texts without words have no postings.
    """
    return materialize(docs.select("doc_id", "text").where(F.col("doc_id").isNotNull()).mapInArrow(_segments(segment_chars), _INDEX), "leak-index")


def _decode(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint32).astype(np.int64))


class _Items:
    """A block of test items as one stream of term numbers, with free places between items."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.terms: dict[str, int] = {}
        stream, item = [], []
        for item_id, words in rows:
            stream += [-2] * MIN_WORDS + [self.terms.setdefault(w, len(self.terms)) for w in words]
            item += [item_id] * (MIN_WORDS + len(words))
        self.stream = np.array(stream + [-2] * MIN_WORDS, np.int64)
        self.item = np.array(item + [-1] * MIN_WORDS, np.int64)

    def anchors(self, docs: dict[str, int]) -> dict[str, np.ndarray]:
        """Places in the stream of the rarest term of every window of MIN_WORDS words, by term."""
        names = list(self.terms)
        rarity = np.array([docs.get(t, 0) for t in names] or [0], np.int64)
        chosen = set()
        for s in np.flatnonzero(self.stream[: len(self.stream) - MIN_WORDS + 1] >= 0):
            window = self.stream[s : s + MIN_WORDS]
            if (window >= 0).all():
                chosen.add(int(s + np.argmin(rarity[window])))
        by_term: dict[str, list[int]] = {}
        for a in sorted(chosen):
            by_term.setdefault(names[self.stream[a]], []).append(a)
        return {t: np.array(x, np.int64) for t, x in by_term.items()}


def _matches(items: _Items, anchors: dict[str, np.ndarray], min_words: int):
    """A function of one segment's postings: the (doc_id, item_id) that share min_words consecutive words."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        places = {t: _decode(raw) for t, raw in zip(pdf["term"], pdf["places"]) if t is not None}
        head = pdf[pdf["term"].isna()].iloc[0]
        starts, doc_ids = np.frombuffer(head["places"], np.uint32).astype(np.int64), np.array(head["doc_ids"], np.int64)
        pad = min_words
        text = np.full(max([0, *(int(p[-1]) for p in places.values())]) + 2 * pad + 1, -1, np.int64)
        for t, p in places.items():
            text[p + pad] = items.terms[t]
        found = []
        for t, offsets in anchors.items():
            if t not in places:
                continue
            # a common anchor stands in many places of the segment and of the items: so many pairs of them at a time
            step_ = max(1, PAIRS // len(places[t]))
            for part in (offsets[i : i + step_] for i in range(0, len(offsets), step_)):
                p, a = np.repeat(places[t], len(part)) + pad, np.tile(part, len(places[t]))
                run = np.ones(len(p), np.int64)
                for step in (-1, 1):
                    alive = np.arange(len(p))
                    for k in range(1, min_words):
                        alive = alive[text[p[alive] + step * k] == items.stream[a[alive] + step * k]]
                        if not alive.size:
                            break
                        run[alive] += 1
                hit = run >= min_words
                found.append(np.unique(np.stack([doc_ids[np.searchsorted(starts, p[hit] - pad, "right") - 1], items.item[a[hit]]]), axis=1))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"doc_id": pairs[0], "item_id": pairs[1]})

    return search


def _near(rare: dict[int, list[str]], near: int, span: int):
    """A function of one segment's postings: (doc_id, item_id, terms) where near rare terms of an item stand within span words."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        places = {t: _decode(raw) for t, raw in zip(pdf["term"], pdf["places"]) if t is not None}
        head = pdf[pdf["term"].isna()].iloc[0]
        starts, doc_ids = np.frombuffer(head["places"], np.uint32).astype(np.int64), np.array(head["doc_ids"], np.int64)
        best: dict[tuple[int, int], int] = {}
        for item_id, terms in rare.items():
            lists = [places[t] for t in terms if t in places]
            if len(lists) < min(near, len(terms)):
                continue
            at, which = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            order = np.argsort(at, kind="stable")
            at, which = at[order], which[order]
            doc = np.searchsorted(starts, at, "right")
            # the last place of each term before every place: how many lie within the span and the document
            recent = np.zeros(len(at), np.int64)
            for k in range(len(lists)):
                last = np.maximum.accumulate(np.where(which == k, np.arange(len(at)), -1))
                ok = last >= 0
                recent += ok & (at - at[last] < span) & (doc[last] == doc)
            for d, n in zip(doc[recent >= min(near, len(terms))], recent[recent >= min(near, len(terms))]):
                key = (int(doc_ids[d - 1]), item_id)
                best[key] = max(best.get(key, 0), int(n))
        return pd.DataFrame([(d, i, n) for (d, i), n in best.items()], columns=["doc_id", "item_id", "terms"]).astype("int64")

    return search


def _item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The items in blocks of about block_words words, so that any number of them can be searched for."""
    items = items.where(F.col("item_id").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // (4 * block_words)) + 1
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else items
        yield [(r[0], words_of(r[1])) for r in part.select("item_id", "text").sort("item_id").collect()]


def _postings_of(index: DataFrame, terms: list[str]) -> DataFrame:
    """The index's rows of the given terms, and of the documents of every segment."""
    wanted = index.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return index.where("term is not null").join(F.broadcast(wanted), "term", "left_semi")  # at most a block's words


def _search(index: DataFrame, postings: DataFrame, function, schema: str) -> DataFrame:
    heads = index.where("term is null").select(*postings.columns)
    return postings.unionByName(heads).groupBy("segment").applyInPandas(function, schema)


def phrases(index: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id): documents that hold at least min_words consecutive words of an item.

    items: (item_id, text). Items with fewer words or null text are in no
    document; items that share text are each reported.
    """
    out = None
    for rows in _item_blocks(items, block_words):
        block = _Items(rows)
        postings = _postings_of(index, list(block.terms))
        docs = dict(postings.groupBy("term").agg(F.sum("docs")).collect())  # at most a block's words
        found = _search(index, postings, _matches(block, block.anchors(docs), min_words), "doc_id long, item_id long")
        out = found if out is None else out.unionByName(found)
    return out


def near_matches(index: DataFrame, items: DataFrame, near: int = NEAR, span: int = SPAN, rare: int = RARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, terms): documents with near of an item's rarest terms within span words, in any order.

    terms is the largest number found together. Items with fewer than near
    distinct words are not searched for.
    """
    out = None
    for rows in _item_blocks(items, block_words):
        postings = _postings_of(index, sorted({w for _, words in rows for w in words}))
        docs = dict(postings.groupBy("term").agg(F.sum("docs")).collect())
        chosen = {i: sorted(set(words), key=lambda w: (docs.get(w, 0), w))[:rare] for i, words in rows if len(set(words)) >= near}
        few = postings.join(F.broadcast(index.sparkSession.createDataFrame([(t,) for t in sorted({t for x in chosen.values() for t in x})], "term string")), "term", "left_semi")
        found = _search(index, few, _near(chosen, near, span), "doc_id long, item_id long, terms long")
        out = found if out is None else out.unionByName(found)
    return out
