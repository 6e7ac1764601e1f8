"""Has this key been seen before? Scalable Bloom chains over key shards.

Keys are reduced to two 64-bit hashes and sharded by hash; the number of shards
follows from the number of keys, so that a shard's chain fits in a task. A
shard keeps a chain of Bloom layers: when a layer has taken in its capacity, a
layer GROWTH times as large with an error rate TIGHTENING times as high is
added, so the compounded false-positive rate stays below ``rate`` for any
length of history.

Chains of earlier keys are kept as a table (``extend_chains``) instead of the
keys. New arrivals pass through their shard's chain in order of arrival:
"not seen" is certain, and such keys are taken in. Only "maybe" answers are
checked. The arrival that first brought a key, answered "not seen", is the
evidence for the later ones; a second, small chain of the doubtful keys of the
shard picks those out, so all other new keys, most of a crawl, leave the
computation with the chain's answer. A doubtful key without such an arrival is
looked up among the earlier keys; if it isn't there, its first "maybe" was
wrong, which gives the measured rate of wrong answers.

A hot key is not a hot shard: within an Arrow batch only the earliest arrival
of a key goes on, later ones are known to be repeats. Two keys count as the
same string if both their 64-bit hashes agree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import materialize

#: Keys that the first layer of a shard takes in, and how layers grow.
FIRST_CAPACITY = 4096
GROWTH = 2
TIGHTENING = 0.5
#: Bound of the compounded false-positive rate of a chain, and of the chain of a shard's doubtful keys.
RATE, DOUBT_RATE = 1e-4, 1e-2
#: Keys of a shard: at a rate of 1e-4 a key takes 3 to 4 bytes of its chain.
SHARD_KEYS = 4_000_000
#: What is known of an arrival: its key is surely new, may have come, came earlier in the batch, or is new and was asked for again.
NEW, MAYBE, REPEAT, EVIDENCE = 0, 1, 2, 3

ARRIVALS = "stream string, id long, pos long, h1 long, h2 long, status int"
_ROWS = f"shard int, head int, {ARRIVALS}, chain binary"
CHAINS = "shard int, keys long, bound double, chain binary"


class BloomChain:
    """Layers of Bloom filters over pairs of 64-bit hashes, with a bound on the compounded error."""

    def __init__(self, rate: float = RATE, capacity: int = FIRST_CAPACITY):
        if not 0 < rate < 1 or capacity < 1:
            raise ValueError("rate must lie in (0, 1) and capacity be positive")
        self.rate, self.capacity = rate, capacity
        self.layers: list[dict] = []

    def _grow(self) -> dict:
        i = len(self.layers)
        p = self.rate * (1 - TIGHTENING) * TIGHTENING**i
        capacity = self.capacity * GROWTH**i
        size = max(64, ceil(capacity * log(1 / p) / log(2) ** 2))
        self.layers.append({"words": np.zeros(size // 64 + 1, np.uint64), "size": size, "hashes": max(1, round(log2(1 / p))), "capacity": capacity, "keys": 0, "rate": p})
        return self.layers[-1]

    @property
    def keys(self) -> int:
        return sum(layer["keys"] for layer in self.layers)

    @property
    def bound(self) -> float:
        """False-positive rate that the layers in use can add up to."""
        return sum(layer["rate"] for layer in self.layers)

    def to_bytes(self) -> bytes:
        """The chain as bytes, for keeping it instead of the keys."""
        head = [{k: v for k, v in layer.items() if k != "words"} for layer in self.layers]
        meta = json.dumps({"rate": self.rate, "capacity": self.capacity, "layers": head}).encode()
        return len(meta).to_bytes(4, "big") + meta + b"".join(layer["words"].tobytes() for layer in self.layers)

    @staticmethod
    def from_bytes(raw: bytes) -> BloomChain:
        """The chain of to_bytes; it can take in more keys."""
        at = 4 + int.from_bytes(raw[:4], "big")
        meta = json.loads(raw[4:at])
        chain = BloomChain(meta["rate"], meta["capacity"])
        for layer in meta["layers"]:
            n = layer["size"] // 64 + 1
            chain.layers.append(layer | {"words": np.frombuffer(raw, np.uint64, n, at).copy()})
            at += 8 * n
        return chain

    @staticmethod
    def _place(layer: dict, k: int, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (h1 + np.uint64(k) * (h2 | np.uint64(1))) % np.uint64(layer["size"])
        return at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))

    def maybe(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """True where a key may have been added; False is certain."""
        found = np.zeros(len(h1), bool)
        for layer in self.layers:
            alive = np.flatnonzero(~found)
            for k in range(layer["hashes"]):
                if not alive.size:
                    break
                word, bit = self._place(layer, k, h1[alive], h2[alive])
                alive = alive[layer["words"][word] & bit != 0]
            found[alive] = True
        return found

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take in keys; a layer is added whenever the last one is full."""
        at = 0
        while at < len(h1):
            layer = self.layers[-1] if self.layers else self._grow()
            if layer["keys"] >= layer["capacity"]:
                layer = self._grow()
            upto = min(len(h1), at + layer["capacity"] - layer["keys"])
            for k in range(layer["hashes"]):
                np.bitwise_or.at(layer["words"], *self._place(layer, k, h1[at:upto], h2[at:upto]))
            layer["keys"] += upto - at
            at = upto


def shards_for(keys: int, least: int = 1) -> int:
    """Shards for so many keys: as many as keep SHARD_KEYS a shard, at least least."""
    return max(1, least, -(-keys // SHARD_KEYS))


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _pair(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(x.view(np.uint64) for x in _columns(batch, "h1", "h2"))


def _repeats(h1: np.ndarray, h2: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """True where the same key stands at a strictly smaller place of the batch's order."""
    by_key = np.lexsort((*reversed(order), h2, h1))
    a, b = h1[by_key], h2[by_key]
    starts = np.ones(len(a), bool)
    starts[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = by_key[np.maximum.accumulate(np.where(starts, np.arange(len(a)), 0))]
    later = np.zeros(len(a), bool)
    for x in order:
        later |= x[by_key] != x[first]
    out = np.zeros(len(a), bool)
    out[by_key] = later
    return out


def _with_status(batch: pa.RecordBatch, status: np.ndarray) -> pa.RecordBatch:
    # all fields nullable, as in the batches that are made anew
    columns = [pa.array(status, pa.int32()) if n == "status" else c for n, c in zip(batch.schema.names, batch.columns)]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _mark_batch_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _with_status(batch, np.where(_repeats(*_columns(batch, "h1", "h2", "id", "pos")), REPEAT, MAYBE))


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(shard, its next rows) of batches sorted by shard; a shard's chain, if it has one, stands in its first row."""
    for batch in batches:
        (shard,) = _columns(batch, "shard")
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield int(shard[a]), batch.slice(a, b - a)


def _through_chains(rate: float, visit, finish=None):
    """An Arrow function of _ROWS: visit(chain, rows) for each shard's rows, finish(shard, chain) after its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain = None, None
        for shard, rows in _by_shard(batches):
            if shard != now:
                if now is not None and finish:
                    yield from finish(now, chain)
                now, chain = shard, BloomChain(rate)
                first = rows.column("chain")[0].as_py()
                if first is not None:
                    chain, rows = BloomChain.from_bytes(first), rows.slice(1)
            if rows.num_rows:
                yield from visit(chain, rows)
        if now is not None and finish:
            yield from finish(now, chain)

    return run


def _row_of(shard: int, chain: BloomChain) -> pa.RecordBatch:
    """The row of _ROWS that brings a chain to its shard."""
    names = ["shard", "head", "stream", "id", "pos", "h1", "h2", "status", "chain"]
    types = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([shard, 0, None, 0, 0, 0, 0, NEW, chain.to_bytes()], types)], names=names)


def _ask_in_order(rate: float):
    """Answers NEW or MAYBE in order of arrival, takes new keys in, and ends each shard with the chain of its doubtful keys."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubtful: dict[int, BloomChain] = {}

        def visit(chain: BloomChain, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            shard, status = _columns(batch, "shard", "status")
            asked = np.flatnonzero(status != REPEAT)
            h1, h2, *order = (x[asked] for x in _columns(batch, "h1", "h2", "id", "pos"))
            again = _repeats(h1, h2, *order)
            a, b = h1.view(np.uint64), h2.view(np.uint64)
            maybe = chain.maybe(a, b) | again
            chain.add(a[~maybe], b[~maybe])
            doubt = doubtful.setdefault(int(shard[0]), BloomChain(DOUBT_RATE))
            fresh = maybe.copy()
            fresh[maybe] = ~doubt.maybe(a[maybe], b[maybe])
            doubt.add(a[fresh], b[fresh])
            status = status.copy()
            status[asked] = np.where(maybe, MAYBE, NEW)
            yield _with_status(batch, status)

        def finish(shard: int, chain: BloomChain) -> Iterator[pa.RecordBatch]:
            yield _row_of(shard, doubtful.pop(shard, BloomChain(DOUBT_RATE)))

        yield from _through_chains(rate, visit, finish)(batches)

    return ask


def _find_evidence(doubt: BloomChain, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    (status,) = _columns(batch, "status")
    evidence = (status == NEW) & doubt.maybe(*_pair(batch))
    yield _with_status(batch, np.where(evidence, EVIDENCE, status)).select(["stream", "id", "pos", "h1", "h2", "status"])


def _hash(*columns: str) -> list[Column]:
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(*reversed(columns), F.lit("second")).alias("h2")]


def _placed(keyed: DataFrame, chains: DataFrame | None, shards: int) -> DataFrame:
    """_ROWS of keyed (shard, stream, id, pos, h1, h2, status), each shard in one partition in order of arrival behind its chain."""
    rows = keyed.select("shard", F.lit(1).alias("head"), "stream", "id", "pos", "h1", "h2", "status", F.lit(None).cast("binary").alias("chain"))
    if chains is not None:
        zero = [F.lit(0).cast("long").alias(c) for c in ("id", "pos", "h1", "h2")]
        rows = rows.unionByName(chains.select("shard", F.lit(0).alias("head"), F.lit(None).cast("string").alias("stream"), *zero, F.lit(NEW).alias("status"), "chain"))
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "head", "id", "pos")


@dataclass
class Arrivals:
    """rows: ARRIVALS with the chains' answers; history: (h1, h2) of the earlier keys; both are read only where needed."""

    rows: DataFrame
    history: DataFrame


def arrivals(events: DataFrame, history: DataFrame, rate: float = RATE, shards: int | None = None) -> Arrivals:
    """What the Bloom chains say of every event; the chains of the history are made first and kept as a table.

    events: (stream, id, pos, key), arriving in order of (id, pos) in each
    stream. history: (stream, key), known before the stream's first event.
    Null keys, and events without a place, take no part; an empty key is a key
    like any other. shards defaults to what the number of keys asks for.
    """
    spark = events.sparkSession
    if shards is None:
        shards = shards_for(events.count() + history.count(), spark.sparkContext.defaultParallelism)
    earlier = history.where(F.col("key").isNotNull()).select(*_hash("stream", "key"))
    kept = materialize(_extend(earlier.distinct(), shards, None, rate), "chains")
    place = [F.col(c).cast("long").alias(c) for c in ("id", "pos")]
    valid = F.col("key").isNotNull() & F.col("id").isNotNull() & F.col("pos").isNotNull()
    hashed = events.where(valid).select("stream", *place, *_hash("stream", "key"), F.lit(MAYBE).alias("status"))
    marked = hashed.mapInArrow(_mark_batch_repeats, ARRIVALS)
    # a key's first arrivals meet in one shard; known repeats need none and are spread
    shard = F.pmod(F.when(F.col("status") == REPEAT, F.xxhash64("id", "pos")).otherwise(F.col("h1")), F.lit(shards)).cast("int")
    asked = _placed(marked.withColumn("shard", shard), kept, shards).mapInArrow(_ask_in_order(rate), _ROWS)
    # sorted locally, so that the doubtful keys of a shard stand before its rows
    answered = asked.sortWithinPartitions("shard", "head").mapInArrow(_through_chains(DOUBT_RATE, _find_evidence), ARRIVALS)
    return Arrivals(materialize(answered, "arrivals"), earlier)


def answers(arrived: Arrivals) -> DataFrame:
    """(stream, id, pos, maybe, seen) of the events: the chains' answer and the right one.

    seen: the key stands in the history or arrived at a strictly smaller place
    of the stream. Rows with the same key and the same place don't count as
    each other's predecessors. Only "maybe" answers are checked: against the
    arrival that brought the key, which the chains answered "not seen", or, if
    there is none, against the history.
    """
    rows, place = arrived.rows, F.struct("id", "pos")
    doubtful = (
        rows.where(F.col("status").isin(MAYBE, EVIDENCE))
        .groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max("status").alias("best"), F.min("status").alias("least"))
        .where(F.col("least") == MAYBE)
    )
    # no event brought the key: it is an earlier one, or the first answer was wrong
    unproved = doubtful.where(F.col("best") == MAYBE).select("h1", "h2").join(arrived.history.distinct(), ["h1", "h2"], "left_semi").withColumn("earlier", F.lit(True))
    proof = doubtful.select("h1", "h2", "first").join(unproved, ["h1", "h2"], "left")
    checked = (
        rows.where(F.col("status") == MAYBE)
        .join(proof, ["h1", "h2"])
        .select("stream", "id", "pos", F.lit(True).alias("maybe"), (F.coalesce("earlier", F.lit(False)) | (F.col("first") < place)).alias("seen"))
    )
    repeat = F.col("status") == REPEAT
    sure = rows.where(F.col("status") != MAYBE).select("stream", "id", "pos", repeat.alias("maybe"), repeat.alias("seen"))
    return checked.unionByName(sure)


def error_report(answered: DataFrame, bound: float = RATE) -> DataFrame:
    """(stream, asked, seen, wrong, wrong_rate, in_bound): one row per stream; wrong answers are false "maybe seen" ones.

    in_bound: whether the rate stays within ten times the chains' bound, as it must however few keys were asked.
    """
    wrong = F.sum((F.col("maybe") & ~F.col("seen")).cast("long"))
    unseen = F.sum((~F.col("seen")).cast("long"))
    rate = F.coalesce(F.try_divide(wrong, unseen), F.lit(0.0))
    counts = [F.count(F.lit(1)).alias("asked"), F.sum(F.col("seen").cast("long")).alias("seen"), wrong.alias("wrong"), rate.alias("wrong_rate")]
    return answered.groupBy("stream").agg(*counts).withColumn("in_bound", F.col("wrong_rate") <= 10 * bound)


# --- chains kept instead of the keys ---


def _sharded(pairs: DataFrame, shards: int) -> DataFrame:
    """_placed's columns of keys (h1, h2) whose order doesn't matter."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("id", "pos")]
    return pairs.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), F.lit(None).cast("string").alias("stream"), *zero, "h1", "h2", F.lit(MAYBE).alias("status"))


def _hashed(keys: DataFrame) -> DataFrame:
    """(h1, h2): the distinct non-null keys (key)."""
    return keys.where(F.col("key").isNotNull()).select(*_hash("key")).distinct()


def _take_in(chain: BloomChain, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    h1, h2 = _pair(batch)
    fresh = ~chain.maybe(h1, h2)
    chain.add(h1[fresh], h2[fresh])
    return iter(())


def _as_row(shard: int, chain: BloomChain) -> Iterator[pa.RecordBatch]:
    columns = [pa.array([v], t) for v, t in ((shard, pa.int32()), (chain.keys, pa.int64()), (chain.bound, pa.float64()), (chain.to_bytes(), pa.binary()))]
    yield pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "bound", "chain"])


def _extend(pairs: DataFrame, shards: int, chains: DataFrame | None, rate: float) -> DataFrame:
    return _placed(_sharded(pairs, shards), chains, shards).mapInArrow(_through_chains(rate, _take_in, _as_row), CHAINS)


def extend_chains(keys: DataFrame, shards: int, chains: DataFrame | None = None, rate: float = RATE) -> DataFrame:
    """CHAINS with the keys (key) taken in, one row per shard that has any; chains are those of earlier keys.

    Keys stream past their shard's chain, which is all that a task holds;
    ``shards_for`` tells how many shards keep it small, and chains can only be
    extended with the number of shards that they were made with. Keys that a
    chain already answers for are not added again.
    """
    return _extend(_hashed(keys), shards, chains, rate)


def ask_chains(keys: DataFrame, shards: int, chains: DataFrame) -> DataFrame:
    """keys (key, ...) with column maybe: False if the key surely isn't in the chains; null keys are False.

    Every distinct key is asked once, so a key of many rows costs no more.
    """

    def ask(chain: BloomChain, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.select(["h1", "h2"]).filter(pa.array(chain.maybe(*_pair(batch))))

    hits = _placed(_sharded(_hashed(keys), shards), chains, shards).mapInArrow(_through_chains(RATE, ask), "h1 long, h2 long").withColumn("_hit", F.lit(True))
    named = keys.withColumns(dict(zip(("_h1", "_h2"), _hash("key"))))
    joined = named.join(hits, (named["_h1"] == hits["h1"]) & (named["_h2"] == hits["h2"]), "left")
    return joined.withColumn("maybe", F.coalesce("_hit", F.lit(False)) & F.col("key").isNotNull()).drop("_h1", "_h2", "h1", "h2", "_hit")
