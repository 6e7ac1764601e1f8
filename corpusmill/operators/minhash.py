"""Near-duplicates by MinHash signatures and banding.

Five-word shingles of Unicode words (parity queries: ASCII words), 14 bands of 8 hashes: a pair of similarity 0.8 meets in a
band with probability 0.92. Exact copies (equal shingle sets) are collapsed to
one representative before banding, so a text with a third of all copies is one
row. All pairs of a bucket are verified against the shingles; a large bucket is
cut into blocks, and every pair of blocks is a group of its own.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.components import components

SHINGLE, BANDS, ROWS = 5, 14, 8
SIMILARITY = 0.8
PRIME = (1 << 31) - 1
#: Documents of a block; a bucket has as many blocks as it needs, and all pairs of them are compared.
BLOCK = 2048

#: Words of the parity queries, and of near_duplicates: letters, digits and their marks in any script, one by one
#: in the scripts without blanks between words (Han, kana, Thai, Lao, Burmese, Khmer).
ASCII_WORD = "[a-z0-9]+"
_MARK = "[\u0300-\u036f\u0591-\u05c7\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed\u0900-\u0903\u093a-\u094f\u0951-\u0957\u0981-\u0983\u09bc-\u09cd\u0a01-\u0a4d\u0a81-\u0acd\u0b01-\u0b4d\u0b82-\u0bcd\u0c00-\u0c4d\u0c81-\u0ccd\u0d00-\u0d4d]"
_SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
UNICODE_WORD = f"[{_SINGLE}]|(?:[^\\W_{_SINGLE}]{_MARK}*)+"


def coefficients(n: int = BANDS * ROWS, seed: int = 1) -> list[tuple[int, int]]:
    """n pairs (a, b) of the hash functions (a * h + b) mod PRIME, from a seed."""
    source = random.Random(seed)
    return [(source.randrange(1, PRIME), source.randrange(PRIME)) for _ in range(n)]


def shingles(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(doc_id, h): distinct 31-bit hashes of the n-word shingles of docs (doc_id, text).

    Words are runs of a-z and 0-9 in lower case. Documents with fewer than n
    words have no shingle and so are nobody's near-duplicate.
    """
    tokens = F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda w: w != "")
    spans = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.expr("cast(array() as array<int>)"))
    grams = F.array_distinct(F.transform(spans, lambda i: F.array_join(F.slice("w", i, n), " ")))
    each = docs.where(F.col("text").isNotNull()).select("doc_id", tokens.alias("w")).select("doc_id", F.explode(grams).alias("gram"))
    # hashed as an ordinary column: inside the array function it would not be compiled
    return each.select("doc_id", F.conv(F.substring(F.sha1("gram"), 1, 8), 16, 10).cast("long").bitwiseAND(PRIME).alias("h")).distinct()


def signatures(hashed: DataFrame, pairs: list[tuple[int, int]] | None = None) -> DataFrame:
    """(doc_id, signature array<bigint>): minima of every hash function over a document's shingles."""
    pairs = pairs or coefficients()
    minima = [F.min((F.col("h") * a + b) % PRIME).alias(f"m{i}") for i, (a, b) in enumerate(pairs)]
    return hashed.groupBy("doc_id").agg(*minima).select("doc_id", F.array(*[f"m{i}" for i in range(len(pairs))]).alias("signature"))


def fast_signatures(docs: DataFrame, n: int = SHINGLE, pairs: list[tuple[int, int]] | None = None, words: str = ASCII_WORD, scope: Column | None = None) -> DataFrame:
    """(doc_id, signature, digest, hashes, scope): as signatures, without a shuffle, with a digest and the set of shingle hashes.

    Hashes come from an Arrow batch function; the set is kept for verification.
    words is the pattern of a word in lower-case text (in composed form, if not ASCII_WORD).
    scope (a string, null counts as '') is what the digest is made of besides.
    """
    a, b = (np.array(x, np.int64) for x in zip(*(pairs or coefficients())))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import re
        import unicodedata

        word = re.compile(words)
        for batch in batches:
            ids, sigs, digests, sets, scopes = [], [], [], [], []
            for doc_id, text, own in zip(*(batch.column(c).to_pylist() for c in range(3))):
                text = text or ""
                if words != ASCII_WORD and not text.isascii():
                    text = unicodedata.normalize("NFC", text)
                w = word.findall(text.lower())
                if len(w) < n:
                    continue
                grams = {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}
                h = np.unique(np.array([int.from_bytes(hashlib.sha1(g.encode()).digest()[:4], "big") & PRIME for g in grams], np.int64))
                low = np.full(len(a), PRIME, np.int64)
                for part in np.array_split(h, len(h) // 2000 + 1):
                    low = np.minimum(low, ((part[:, None] * a + b) % PRIME).min(axis=0))
                ids.append(doc_id)
                sigs.append(low.tolist())
                digests.append(hashlib.md5(own.encode() + b"\0" + h.tobytes()).hexdigest())
                sets.append(h.tolist())
                scopes.append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sigs, pa.list_(pa.int64())), pa.array(digests, pa.string()), pa.array(sets, pa.list_(pa.int64())), pa.array(scopes, pa.string())],
                names=["doc_id", "signature", "digest", "hashes", "scope"],
            )

    part = F.lit("") if scope is None else F.coalesce(scope, F.lit(""))
    return docs.select("doc_id", "text", part.alias("scope")).mapInArrow(sign, "doc_id long, signature array<long>, digest string, hashes array<long>, scope string")


def bands(signed: DataFrame, n_bands: int = BANDS, rows: int = ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, band, key): the bucket of each document in each band, with the columns to keep of signed.

    Documents of different scopes, if signed has that column, share no bucket.
    """
    return signed.select("doc_id", *keep, F.posexplode(band_keys("scope" in signed.columns, n_bands, rows)).alias("band", "key"))


def band_keys(scoped: bool, n_bands: int = BANDS, rows: int = ROWS) -> Column:
    """The buckets of column signature, and of column scope if scoped, by band."""
    scope = [F.col("scope")] if scoped else []
    return F.array(*[F.xxhash64(*scope, F.lit(k), F.array_join(F.transform(F.slice("signature", k * rows + 1, rows), lambda x: x.cast("string")), ",")) for k in range(n_bands)])


def bucket_links(banded: DataFrame) -> DataFrame:
    """(a, b), a < b: each document of a bucket with the bucket's first; distinct over all bands."""
    first = banded.groupBy("band", "key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return banded.join(first, ["band", "key"]).where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()


def bucket_pairs(banded: DataFrame, similarity: float, block: int | None = None) -> DataFrame:
    """(a, b), a < b: all pairs of banded (doc_id, size, band, key) with a common bucket; distinct over all bands.

    size is the number of shingles of a document: pairs whose sizes alone rule
    the similarity out are left away, which loses no link. The work is
    quadratic in a bucket's members, in groups of at most about two blocks.
    """
    sizes = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / (block or BLOCK)).cast("int")
    placed = banded.join(sizes, ["band", "key"]).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    met = placed.select("doc_id", "size", "band", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("doc_id", "size", "band", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    group = ["band", "key", "low", "high"]
    one, two = (met.select(*group, *(F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "size", "block"))) for x in "ab")
    # two documents of one block meet in its pair with itself only
    apart = (F.col("doc_id_a") < F.col("doc_id_b")) & ((F.col("block_a") != F.col("block_b")) | (F.col("low") == F.col("high")))
    close = F.least("size_a", "size_b") / F.greatest("size_a", "size_b") >= similarity
    return one.join(two, group).where(apart & close).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, short_copies: bool = False, scope: Column | None = None) -> DataFrame:
    """(doc_id, class_id, links): every document of docs (doc_id unique, text) with the smallest id of its class.

    Classes are the connected components of verified links: all pairs with a
    common bucket whose shingle sets have at least the given Jaccard
    similarity, and exact copies. links counts the representatives that
    the document's representative is linked to. Documents without shingles are their own class;
    with short_copies, those of equal text (blank included, null not) are one
    class, told by a digest of the text. With scope (a string, null counts as ''),
    such as a folder, only documents of one scope are compared, and nothing
    outside it has a part in its classes.
    """
    from corpusmill.scratch import materialize

    # hashes have 31 bits, and of the signature only the buckets are needed
    made = fast_signatures(docs, words=UNICODE_WORD, scope=scope)
    signed = materialize(made.select("doc_id", "digest", F.col("hashes").cast("array<int>").alias("hashes"), band_keys(True).alias("keys")), "signatures")
    copies = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    members = signed.select("doc_id", "digest").join(copies, "digest").select("doc_id", "rep")
    reps = signed.join(copies.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    pairs = bucket_pairs(reps.select("doc_id", F.size("hashes").alias("size"), F.posexplode("keys").alias("band", "key")), similarity)
    left, right = (reps.select(F.col("doc_id").alias(c), F.col("hashes").alias(f"h{c}")) for c in ("a", "b"))
    common = F.size(F.array_intersect("ha", "hb"))
    jaccard = common / (F.size("ha") + F.size("hb") - common)
    links = materialize(pairs.join(left, "a").join(right, "b").where(jaccard >= similarity).select("a", "b"), "links")
    labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    found = members.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").join(degree, "rep", "left")
    classes = found.select("doc_id", F.coalesce("label", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    shown = docs.select("doc_id").join(classes, "doc_id", "left")
    if short_copies:
        part = F.lit("") if scope is None else F.coalesce(scope, F.lit(""))
        bare = docs.where(F.col("text").isNotNull()).select("doc_id", F.sha2(F.concat(part, F.lit("\0"), "text"), 256).alias("digest")).join(signed, "doc_id", "left_anti")
        first = bare.groupBy("digest").agg(F.min("doc_id").alias("first"))
        shown = shown.join(bare.join(first, "digest").select("doc_id", "first"), "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "first"))
    return shown.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def keep_representatives(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): the document with the smallest id of each class, and the others."""
    others = classes.where("doc_id <> class_id").select("doc_id")
    return docs.join(others, "doc_id", "left_anti"), docs.join(others, "doc_id", "left_semi")
