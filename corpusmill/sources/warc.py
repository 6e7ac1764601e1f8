"""WARC files as a Spark data source: one row per record."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "warc_record_id string, type string, url string, date string, content binary"


def records(stream: BinaryIO) -> Iterator[tuple]:
    """Rows of SCHEMA of an uncompressed WARC stream; a truncated last record is dropped."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        size = int(head.get("content-length", "0"))
        body = stream.read(size)
        if len(body) == size:
            yield head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-date"), body


#: Bytes of records that are handed on at a time.
BATCH_BYTES = 32 << 20


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of .warc and .warc.gz files; a file is the unit of work, as the format isn't splittable.

    A file's packed bytes are one cell (2 GB at most, twice the usual size of
    crawl archives); its records are unpacked and handed on as they come.
    """

    def parse(batches):
        import io

        import pandas as pd

        names = ["warc_record_id", "type", "url", "date", "content"]
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                raw = io.BytesIO(content)
                rows, size = [], 0
                for record in records(gzip.open(raw) if name.endswith(".gz") else raw):
                    rows.append(record)
                    size += len(record[-1])
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, SCHEMA)
