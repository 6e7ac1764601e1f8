"""Keyword-stuffed pages and link lists, by suffix automata.

Each page's words are put into a suffix automaton, which gives for every word
the longest run ending there that also stands elsewhere in the page; the
repeated maximal runs of at least RUN words cover a share of each unit's
characters. That coverage is combined with missing clause structure: a unit
without clauses is stuffing if it is made of links or product tags, or of
selling words and repeats, or of repeats nearly throughout.

A page of very many words has an automaton for each stretch of STRETCH words;
runs that stand again only in other stretches are found by the numbers of all
runs of the page, so the coverage is that of one automaton over the page.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import blocks, units

#: Words of a repeated run that count as covered.
RUN = 2
#: Coverage from which selling words, or any words without a clause, are stuffing.
SELLING_COVERED, COVERED = 0.25, 0.85
#: Words that one automaton takes in, which bounds its memory.
STRETCH = 250_000
MIN_CHARS, SPAM_SHARE = 30, 0.5

_PAGE = "doc_id long, chars long, covered double, clauseless double, spam_share double"


def repeats(words: list[str]) -> np.ndarray:
    """For each word, the length of the longest run ending there that stands elsewhere too.

    A word that stands once is in no repeated run, so the automaton is built
    over the stretches between such words.
    """
    times = Counter(words)
    follow: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last, ends = 0, []
    for w in words:
        if times[w] == 1:
            last = 0
            ends.append(0)
            continue
        known = follow[last].get(w)
        if known is not None and length[known] == length[last] + 1:
            last = known  # this stretch runs along an earlier one
            ends.append(last)
            continue
        p = last
        if known is None:
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            while p >= 0 and w not in follow[p]:
                follow[p][w] = new
                p = link[p]
        if p >= 0:
            q = follow[p][w]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(follow[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(w) == q:
                    follow[p][w] = copy
                    p = link[p]
                link[q] = copy
                if known is None:
                    link[new] = copy
                else:
                    new = copy
        last = new
        ends.append(new)
    if not ends:
        return np.zeros(0, np.int64)
    state, links, lengths = np.array(ends, np.int64), np.array(link, np.int64), np.array(length, np.int64)
    # a state that was reached twice, or that others link to, ends in several places
    several = np.bincount(state, minlength=len(links)) > 1
    several[links[1:]] = True
    return np.where(several[state], lengths[state], lengths[np.maximum(links[state], 0)])


def _run_numbers(words: list[str], run: int) -> np.ndarray:
    """For each place, the number of the run of run words that begins there; equal runs have equal numbers."""
    known: dict[str, int] = {}
    word = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    number, base = word, len(known) + 1
    for k in range(1, run):
        number = np.unique(number[:-1] * base + word[k:], return_inverse=True)[1]
    return number


def _mark(size: int, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """True at the places from first to before behind of any span."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, behind, -1)
    return np.cumsum(steps[:-1]) > 0


def covered(words: list[str], run: int = RUN, stretch: int = STRETCH) -> np.ndarray:
    """True for the words inside repeated runs of at least run words.

    A word is in such a run if one of exactly run words around it is repeated,
    so for pages of several stretches the runs of run words that begin in one
    and stand again in another complete what the automata find.
    """
    longest = np.concatenate([repeats(words[i : i + stretch]) for i in range(0, len(words), stretch)] or [np.zeros(0, np.int64)])
    end = np.flatnonzero(longest >= run)
    found = _mark(len(words), end - longest[end] + 1, end + 1)
    if len(words) > max(stretch, run - 1):
        number = _run_numbers(words, run)
        again = np.flatnonzero(np.bincount(number)[number] > 1)
        found |= _mark(len(words), again, again + run)
    return found


def _is_spam(kind: np.ndarray, share: np.ndarray, counts: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """The units that are stuffing, by kind, covered share, words and whether they are marked list items."""
    spam = (kind == units.LINKS) | (kind == units.TAGS) | ((kind == units.SELLING) & (share >= SELLING_COVERED))
    # marked list items may repeat without being keywords
    return spam | (kind != units.SENTENCE) & (share >= COVERED) & (counts >= 4) & (kind != units.JUNK) & ~marked


def page(text: str, lexicon=None) -> tuple[int, float, float, float]:
    """(chars, covered, clauseless, spam_share) of a text: its characters, and shares of those in units."""
    parts = units.units_of(text)
    if not parts:
        return len(text), 0.0, 0.0, 0.0
    words, counts, kinds = [], [], []
    for u in parts:
        kind, found, _ = units.judge(u, lexicon)
        words += found
        counts.append(len(found))
        kinds.append(kind)
    sizes = np.array(list(map(len, words)), np.float64)
    upto = np.concatenate(([0], np.cumsum(counts)))
    sums = np.concatenate(([0.0], np.cumsum(sizes)))
    hits = np.concatenate(([0.0], np.cumsum(sizes * covered(words))))
    share = (hits[upto[1:]] - hits[upto[:-1]]) / np.maximum(sums[upto[1:]] - sums[upto[:-1]], 1)
    chars = np.array([len(u.strip()) for u in parts], np.float64)
    kind = np.array(kinds)
    bare = kind != units.SENTENCE
    marked = np.array([k == units.ITEM and units.is_marked_item(u) for k, u in zip(kinds, parts)])
    spam = _is_spam(kind, share, np.array(counts), marked)
    total = chars.sum()
    return len(text), float((chars * share).sum() / total), float(chars[bare].sum() / total), float(chars[spam].sum() / total)


def _measure(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [page(t, lexicon) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * 4
            types = (pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))], names=["doc_id", "chars", "covered", "clauseless", "spam_share"])

    return run


def measure(docs: DataFrame, lexicon=None) -> DataFrame:
    """(doc_id, chars, covered, clauseless, spam_share) of every document of docs (doc_id, text) with text.

    lexicon: of lexicon.fit. Null texts have no row, blank ones shares of zero;
    nothing is shuffled.
    """
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).mapInArrow(_measure(lexicon), _PAGE)


def _measure_blocks(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in blocks.of(batches):
            begin = block.doc_words()
            parts = [covered(block.numbers[a:b].tolist()) for a, b in zip(begin[:-1], begin[1:])]
            sizes = pc.utf8_length(block.words).to_numpy(zero_copy_only=False)[block.numbers].astype(np.float64)
            size = len(block.unit_words)
            hits = np.bincount(block.unit_of, sizes * np.concatenate(parts), size)
            share = hits / np.maximum(np.bincount(block.unit_of, sizes, size), 1)
            kind = block.kinds(lexicon)
            marked = (kind == units.ITEM) & (block.unit_bits & units.MARKED > 0)
            spam = _is_spam(kind, share, block.unit_words, marked)
            chars = block.unit_visible
            total = np.maximum(block.per_doc(chars), 1)
            shares = [block.per_doc(chars * x) / total for x in (share, kind != units.SENTENCE, spam)]
            columns = [block.doc_ids, pa.array(block.chars, pa.int64()), *(pa.array(x, pa.float64()) for x in shares)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "chars", "covered", "clauseless", "spam_share"])

    return run


def measure_blocks(table: DataFrame, lexicon) -> DataFrame:
    """What measure returns, of a table of blocks.read, whose texts aren't read again."""
    return table.mapInArrow(_measure_blocks(lexicon), _PAGE)


def stuffed(measured: DataFrame) -> DataFrame:
    """The measured pages of at least MIN_CHARS characters with more than SPAM_SHARE of stuffing."""
    return measured.where((F.col("chars") >= MIN_CHARS) & (F.col("spam_share") > SPAM_SHARE))
