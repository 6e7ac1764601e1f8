"""Record keys and shard numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shards of the key registry.
SHARDS = 2000


def joined(*columns: Column) -> Column:
    """The columns as strings joined by '|', null written 'nan'."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("nan")) for c in columns])


def row_md5(*columns: Column) -> Column:
    """MD5 hex digest of the columns."""
    return F.md5(joined(*columns))


def row_sha(*columns: Column) -> Column:
    """SHA-256 hex digest of the columns."""
    return F.sha2(joined(*columns), 256)


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """First 8 bytes of the key's SHA-256, big-endian, modulo shards; null for a null key."""
    head = F.substring(F.sha2(key, 256), 1, 16)
    # two 32-bit halves keep the arithmetic inside a long
    high, low = (F.conv(F.substring(head, at, 8), 16, 10).cast("long") for at in (1, 9))
    return ((high % shards) * (2**32 % shards) + low) % shards
