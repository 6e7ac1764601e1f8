"""Encoding of a corpus with a public byte-level BPE vocabulary.

Global distinct-word shuffle. Documents are cut into pre-tokens and packed
into blocks; a block keeps its distinct pre-tokens once and its documents as
positions into them. The distinct pre-tokens of all blocks are shuffled by
word, each is encoded exactly once, the ids are joined back to the blocks, and
every block is reassembled by position. What is shuffled grows with the
distinct words of the blocks, not with the number of tokens. A frequent word
is one row per block, so no word is a hot key.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import materialize

#: Where the public vocabulary files are; a parameter of every operator here.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pre-tokens of the vocabulary (a fixed value of its definition).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text after which a block is closed; a longer text is a block of its own.
BLOCK_CHARS = 2_000_000
#: Blocks of a group, about: rows of a word that stands in every block.
GROUP_BLOCKS = 1024
#: Blocks that a task of the last shuffle reassembles, about.
TASK_BLOCKS = 2

_BLOCK = "block long, words array<string>, doc_ids array<long>, lengths array<int>, places binary"


@cache
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def _encoder(path: str) -> Callable[[str], list[int]]:
    import tiktoken

    encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={})
    return encoding.encode_ordinary


def _blocks(block_chars: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        pieces = regex.compile(PATTERN).findall
        task, made = TaskContext.get().partitionId(), 0
        number: dict[str, int] = {}
        doc_ids, lengths, places, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            packed = pa.compress(np.array(places, np.uint32).tobytes(), codec="zstd", asbytes=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made], pa.int64()),
                    pa.array([list(number)], pa.list_(pa.string())),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([packed], pa.binary()),
                ],
                names=["block", "words", "doc_ids", "lengths", "places"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = pieces(text) if text else []
                places += [number.setdefault(w, len(number)) for w in words]
                doc_ids.append(doc_id)
                lengths.append(len(words))
                size += len(text or "")
                if size >= block_chars:
                    yield block()
                    made += 1
                    number, doc_ids, lengths, places, size = {}, [], [], [], 0
        if doc_ids:
            yield block()

    return cut


def _encode_words(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _encoder(path)
        for batch in batches:
            ids = [ids_of(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["word", "groups", "ids"])

    return encode


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            doc_ids = batch.column("doc_ids")[row].values
            lengths = batch.column("lengths")[row].values.to_numpy().astype(np.int64)
            raw = batch.column("places")[row].as_py()
            total = int(lengths.sum())
            places = np.frombuffer(pa.decompress(raw, decompressed_size=4 * total, codec="zstd", asbytes=True), np.uint32) if total else np.zeros(0, np.uint32)
            words = batch.column("words")[row].values
            at = np.zeros(0, np.int64) if words is None else words.field("at").to_numpy()
            order = np.argsort(at, kind="stable")
            ids = pa.array([], pa.list_(pa.int32())) if words is None else words.field("ids").take(pa.array(order))
            flat, starts = ids.flatten().to_numpy(), np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy()))).astype(np.int64)
            sizes = np.diff(starts)[places]
            ends = np.cumsum(sizes)
            take = np.repeat(starts[:-1][places] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if total else 0)
            upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lengths)))]
            out = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat[take], pa.int32()))
            for start in range(0, len(doc_ids), 1000):
                yield pa.RecordBatch.from_arrays([doc_ids.slice(start, 1000), out.slice(start, 1000)], names=["doc_id", "ids"])


def encode(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids array<int>): every document of docs (doc_id, text), without special tokens.

    Empty and null texts give the empty array; strings that look like special
    tokens are plain text. Rows with equal doc_id are encoded each for itself.
    tokenizer_dir must be readable on every executor.
    """
    path = os.path.join(tokenizer_dir, VOCABULARY)
    blocks = materialize(docs.select("doc_id", "text").mapInArrow(_blocks(block_chars), _BLOCK), "token-blocks")
    n = blocks.count()
    groups, parts = -(-n // GROUP_BLOCKS) or 1, max(n // TASK_BLOCKS, 1)
    words = blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"), F.posexplode("words").alias("at", "word"))
    distinct = words.groupBy("word").agg(F.collect_set("group").alias("groups"))
    encoded = distinct.mapInArrow(_encode_words(path), "word string, groups array<long>, ids array<int>")
    ids = encoded.select(F.explode("groups").alias("group"), "word", "ids")
    # bounded: as many as a block has distinct words
    # the size of exploded rows is underestimated: no broadcast
    known = words.join(ids.hint("merge"), ["group", "word"]).repartition(parts, "block").groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("words"))
    packed = blocks.drop("words").repartition(parts, "block")
    return packed.join(known, "block", "left").select("doc_ids", "lengths", "places", "words").mapInArrow(_reassemble, "doc_id long, ids array<int>")


def token_table(spark, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(id, hex): the bytes of each token of the vocabulary; about 50,000 rows."""
    ranks = _ranks(os.path.join(tokenizer_dir, VOCABULARY))
    return spark.createDataFrame([(i, b.hex()) for b, i in ranks.items()], "id int, hex string")


def decode(encoded: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of encoded (doc_id unique, ids); the empty array gives the empty text.

    Joins the token-byte table, whose size is that of the vocabulary; an id
    that isn't in it raises an error rather than vanish.
    """
    each = encoded.select("doc_id", F.posexplode("ids").alias("at", "id")).join(F.broadcast(tokens), "id", "left")
    known = F.coalesce("hex", F.raise_error(F.concat(F.lit("unknown token id "), F.col("id").cast("string"))).cast("string"))
    pieces = each.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", known.alias("hex")))).alias("p"))
    text = F.decode(F.unhex(F.array_join(F.col("p.hex"), "")), "UTF-8")
    return encoded.select("doc_id").join(pieces, "doc_id", "left").select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
