"""Per-document text statistics, and the documents that are not natural prose.

Huge documents are split into chunks that are counted apart. A chunk's state
is a set of sums plus the open unit at either end (the text before its first
and after its last unit boundary), so that states merge associatively: the end
of one chunk and the beginning of the next are joined and counted as one unit,
however long it is; a state is never larger than its part of the text. The
sums are those of the whole text, whatever the size of a chunk.
States of a document are merged in a tree (GROUP chunks at a time), ratios and
rule outcomes are derived from the merged sums. Documents of one chunk, nearly
all, are counted in the scan and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import blocks, units

CHUNK_CHARS = 1 << 16
#: Chunk states merged at a time.
GROUP = 64
#: Headings of a document that count as such; more are a list.
HEADINGS = 6
#: Texts below are not judged, and share of characters outside sentences above which a text is not prose.
MIN_CHARS, NOT_PROSE = 30, 0.5

#: Counted over units, in one piece or joined from two chunks.
OF_UNITS = ["words", "word_chars", "common_words", "headings", *(f"{k}_chars" for k in units.KINDS)]
SUMS = ["chars", "symbols", "lines", "ended_lines", *OF_UNITS]
#: head, tail: the open units at both ends, tail null if the chunk has no unit boundary.
#: broken: whether it has a line break; first_end, last_end: last visible characters of its open lines, '' if blank.
_STATE = "doc_id long, chunk long, head string, tail string, broken boolean, first_end string, last_end string, " + ", ".join(f"{c} long" for c in SUMS)

#: What ends a line of prose, and what may stand behind it.
_STOPS, _CLOSING = frozenset(".!?。！？…"), " \t\r\x0b\x0c\xa0\"'”»)]"
_SYMBOL = re.compile(r"[^\w\s]|_")


def count_units(text: str, lexicon=None) -> list[int]:
    """OF_UNITS of a text whose ends are unit boundaries."""
    words = word_chars = common = headings = 0
    by_kind = [0] * len(units.KINDS)
    for unit in units.units_of(text):
        kind, found, small = units.judge(unit, lexicon)
        words += len(found)
        word_chars += sum(map(len, found))
        common += small
        headings += kind == units.HEADING
        by_kind[kind] += len(unit.strip())
    return [words, word_chars, common, headings, *by_kind]


def _ends(lines: list[str]) -> list[str]:
    return [line.rstrip(_CLOSING)[-1:] for line in lines]


def count_text(text: str) -> list[int]:
    """The SUMS of a whole text that aren't OF_UNITS."""
    ends = [e for e in _ends(text.split("\n")) if e]
    return [len(text), len(_SYMBOL.findall(text)), len(ends), sum(e in _STOPS for e in ends)]


def count(text: str, lexicon=None) -> list[int]:
    """SUMS of a whole text."""
    return [*count_text(text), *count_units(text, lexicon)]


def chunk_state(text: str, lexicon=None) -> tuple:
    """(head, tail, broken, first_end, last_end, sums) of a chunk of a text."""
    ends = _ends(text.split("\n"))
    inner = [e for e in ends[1:-1] if e]
    additive = [len(text), len(_SYMBOL.findall(text)), len(inner), sum(e in _STOPS for e in inner)]
    marks = [m.end() for m in units.BREAK.finditer(text)]
    head, tail = (text[: marks[0]], text[marks[-1] :]) if marks else (text, None)
    closed = count_units(text[marks[0] : marks[-1]], lexicon) if marks else [0] * len(OF_UNITS)
    return head, tail, len(ends) > 1, ends[0], ends[-1], [*additive, *closed]


def merge(x: tuple, y: tuple, lexicon=None) -> tuple:
    """The state of two neighbouring chunks, as if they had been one."""
    (xh, xt, xb, xf, xl, xs), (yh, yt, yb, yf, yl, ys) = x, y
    sums = [a + b for a, b in zip(xs, ys)]
    k = len(SUMS) - len(OF_UNITS)
    if xt is not None and yt is not None:
        sums[k:] = [a + b for a, b in zip(sums[k:], count_units(xt + yh, lexicon))]
    head, tail = (xh + yh, yt) if xt is None else (xh, xt + yh if yt is None else yt)
    if xb and yb:  # the line between them is complete
        end = yf or xl
        sums[2] += bool(end)
        sums[3] += end in _STOPS
    first = xf if xb else yf or xf
    last = yl if yb else yl or xl
    return head, tail, xb or yb, first, last, sums


def finish(state: tuple, lexicon=None) -> list[int]:
    """SUMS of a text from its merged state: the open ends are the text's own."""
    head, tail, broken, first, last, sums = state
    k = len(SUMS) - len(OF_UNITS)
    ends = [e for e in ([first, last] if broken else [last or first]) if e]
    sums = [*sums[:2], sums[2] + len(ends), sums[3] + sum(e in _STOPS for e in ends), *sums[k:]]
    for piece in (head, tail):
        if piece:
            sums[k:] = [a + b for a, b in zip(sums[k:], count_units(piece, lexicon))]
    return sums


_NAMES = ["doc_id", "chunk", "head", "tail", "broken", "first_end", "last_end", *SUMS]


def _rows(states: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*states)) or [[]] * len(_NAMES)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string()] + [pa.int64()] * len(SUMS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def _count_whole(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([(i, 0, "", "", False, "", "", *count(t, lexicon)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])

    return run


def _count_blocks(chunk_chars: int, lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in blocks.of(batches):
            kind = block.kinds(lexicon)
            sizes = pc.utf8_length(block.words).to_numpy(zero_copy_only=False)
            of_units = [block.unit_words, block.per_unit(sizes), block.per_unit(block.among(lexicon.clause)), kind == units.HEADING]
            of_units += [block.unit_visible * (kind == k) for k in range(len(units.KINDS))]
            of_text = np.array(block.of_text, np.int64).reshape(len(block.chars), -1).T
            short = pa.array(np.array(block.chars, np.int64) <= chunk_chars)
            columns = [block.doc_ids, *map(pa.array, of_text), *(pa.array(block.per_doc(x).astype(np.int64)) for x in of_units)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *SUMS]).filter(short)

    return run


def _cut(chunk_chars: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = -(-len(t) // chunk_chars)
                parts = [t[k * chunk_chars : (k + 1) * chunk_chars] for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(parts, pa.string())], names=["doc_id", "chunk", "text"])

    return cut


def _count_chunks(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, k, t in zip(*(batch.column(c).to_pylist() for c in range(3))):
                *ends, counted = chunk_state(t, lexicon)
                out.append((i, k, *ends, *counted))
            yield _rows(out)

    return run


def _merge_group(last: bool, lexicon):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        state = None
        for row in pdf.sort_values("chunk", kind="stable").itertuples(index=False):
            tail = row.tail if isinstance(row.tail, str) else None
            own = (row.head, tail, bool(row.broken), row.first_end, row.last_end, [int(getattr(row, c)) for c in SUMS])
            state = own if state is None else merge(state, own, lexicon)
        key = (int(pdf["doc_id"].iloc[0]), int(pdf["chunk"].min()) // GROUP)
        values = ("", "", False, "", "", *finish(state, lexicon)) if last else (*state[:5], *state[5])
        return pd.DataFrame([(*key, *values)], columns=_NAMES)

    return run


def sums(docs: DataFrame, chunk_chars: int = CHUNK_CHARS, lexicon=None, table: DataFrame | None = None) -> DataFrame:
    """doc_id and SUMS of every document of docs (doc_id unique, text) whose id and text aren't null; lexicon: of lexicon.fit.

    table: docs by blocks.read with count_text; with it and a lexicon, only the
    texts that are split into chunks are read again.
    """
    present = docs.select("doc_id", "text").where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if table is None:
        whole = present.where(F.length("text") <= chunk_chars).mapInArrow(_count_whole(lexicon), _STATE).select("doc_id", *SUMS)
    else:
        whole = table.mapInArrow(_count_blocks(chunk_chars, lexicon), "doc_id long, " + ", ".join(f"{c} long" for c in SUMS)).where(F.col("doc_id").isNotNull())
    chunks = present.where(F.length("text") > chunk_chars).mapInArrow(_cut(chunk_chars), "doc_id long, chunk long, text string")
    # chunks of one document are counted wherever there is room
    states = chunks.repartition("doc_id", "chunk").mapInArrow(_count_chunks(lexicon), _STATE)
    grouped = states.groupBy("doc_id", F.floor(F.col("chunk") / GROUP).alias("g")).applyInPandas(_merge_group(False, lexicon), _STATE)
    merged = grouped.groupBy("doc_id").applyInPandas(_merge_group(True, lexicon), _STATE)
    return whole.unionByName(merged.select("doc_id", *SUMS))


def statistics(summed: DataFrame) -> DataFrame:
    """Ratios and rule outcomes of the sums.

    An empty or blank text has ratios 0. not_prose: more than NOT_PROSE of the
    characters of its units lie outside sentences, up to HEADINGS headings
    aside; never for texts under MIN_CHARS characters.
    """
    units_chars = sum((F.col(f"{k}_chars") for k in units.KINDS[1:]), F.col(f"{units.KINDS[0]}_chars"))
    headings = F.when(F.col("headings") > HEADINGS, F.col("heading_chars")).otherwise(0)
    outside = sum((F.col(f"{k}_chars") for k in units.KINDS[2:]), headings)

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return summed.select(
        "doc_id",
        "chars",
        "words",
        "lines",
        ratio(F.col("word_chars"), F.col("words")).alias("mean_word_length"),
        ratio(F.col("symbols"), F.col("chars")).alias("symbol_ratio"),
        ratio(F.col("ended_lines"), F.col("lines")).alias("ended_line_share"),
        ratio(F.col("common_words"), F.col("words")).alias("common_word_share"),
        ratio(outside, units_chars).alias("outside_share"),
        ((F.col("chars") >= MIN_CHARS) & (outside > NOT_PROSE * units_chars)).alias("not_prose"),
    )
