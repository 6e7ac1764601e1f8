"""Typed readers; rejects stay observable."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import labels

#: Path keywords in order of priority.
_FORMATS = (("jsonl", "jsonl"), ("parquet", "parquet"), ("warc", "warc"))
CORRUPT = "_corrupt_record"


def guess_format(path: str) -> str:
    """jsonl, parquet, warc or else csv, by the first keyword found in the path, case aside."""
    low = path.lower()
    return next((fmt for word, fmt in _FORMATS if word in low), "csv")


def format_of(path: Column) -> Column:
    """guess_format of a column of paths; null gives csv."""
    found = F.lit("csv")
    for word, fmt in reversed(_FORMATS):
        found = F.when(F.contains(F.lower(path), F.lit(word)), F.lit(fmt)).otherwise(found)
    return found


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, tolerant: bool = False, multi_line: bool = True, recursive: bool = False) -> DataFrame:
    """CSV with header; recursive reads the files at any depth. tolerant drops malformed rows instead of failing.

    Quoted texts may span lines, so each file is one task; with multi_line off
    they may not, and large files are split.
    """
    mode = "DROPMALFORMED" if tolerant else "FAILFAST"
    reader = spark.read.schema(schema).option("recursiveFileLookup", recursive)
    return reader.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', mode=mode, maxCharsPerColumn=-1)


def read_csv_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows as column value) of CSV with header."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "maxCharsPerColumn": -1}
    rows = spark.read.schema(full).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
    # Spark refuses to read the corrupt column alone, so the filter reads another one, too, which decides nothing
    other = F.substring(F.coalesce(F.col(schema.names[0]).cast("string"), F.lit("")), 1, 0) == ""
    bad = F.col(CORRUPT).isNotNull() & other
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(F.col(CORRUPT).alias("value"))


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None) -> DataFrame:
    """JSON lines, also .gz, .zst and .zstd; a bad line raises an error. glob filters file names at any depth."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines as column value) of JSON lines."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.where(~bad).select(*[F.col(f"r.`{f.name}`") for f in schema.fields]), parsed.where(bad).select("value")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON array (or object) per file."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A reader chosen by guess_format."""
    fmt = guess_format(path)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "warc":
        from corpusmill.sources.warc import read_warc

        return read_warc(spark, path)
    return read_jsonl(spark, path, schema) if fmt == "jsonl" else read_csv(spark, path, schema)


def read_excel(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One sheet of an Excel file, which pandas reads on the driver: for small hand-made tables."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path), schema)


def with_folder(df: DataFrame, root: str) -> DataFrame:
    """df with column folder: the first folder below root that the row's file lies in, '' for files in root itself."""
    name = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    below = F.regexp_extract(F.col("_metadata.file_path"), f"/{name}/([^/]+)/", 1)
    return df.select("*", below.alias("folder"))


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """(label, text, ok) of label lines (value): split at the first blank; blank lines are skipped.

    ok is false for lines without text or with a label that lacks the prefix.
    """
    value = F.trim("value")
    parts = F.split(value, " ", 2)
    ok = (F.size(parts) == 2) & parts[0].startswith(labels.PREFIX)
    return lines.where(F.coalesce(value, F.lit("")) != "").select(parts[0].alias("label"), F.get(parts, F.lit(1)).alias("text"), ok.alias("ok"))


def unprocessed(spark: SparkSession, files: DataFrame, manifest: str) -> DataFrame:
    """The rows of files (path, ...) whose path isn't in the manifest table yet; all if there is no manifest."""
    try:
        done = spark.read.parquet(manifest).select("path")
    except Exception as error:  # no manifest written so far
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return files
    return files.join(done, "path", "left_anti")


#: Lines or records of a file that are handed on at a time.
FILE_BATCH = 5000


def read_jsonl_by_file(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with column path, failed files as path and error) of .jsonl, .gz, .zst and .zstd files.

    A file that cannot be unpacked or parsed is reported instead of failing
    the scan, and none of its rows are returned. A file's packed bytes are one
    cell (2 GB at most); its lines are unpacked and handed on in batches.
    """

    def lines_of(name: str, content: bytes):
        import gzip
        import io

        raw = io.BytesIO(content)
        if name.endswith((".zst", ".zstd")):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
        elif name.endswith(".gz"):
            raw = gzip.GzipFile(fileobj=raw)
        for line in io.TextIOWrapper(io.BufferedReader(raw), "utf-8", newline="\n"):
            if line.strip():
                yield line.rstrip("\n")

    def parse(batches):
        import itertools
        import json

        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                try:
                    for line in lines_of(name, content):  # a first pass, since a file counts as a whole
                        json.loads(line)
                except Exception as error:
                    yield pd.DataFrame({"path": [name], "value": [None], "error": [f"{type(error).__name__}: {error}"]})
                    continue
                lines = lines_of(name, content)
                while some := list(itertools.islice(lines, FILE_BATCH)):
                    yield pd.DataFrame({"path": name, "value": some, "error": None}, columns=["path", "value", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    parsed = files.mapInPandas(parse, "path string, value string, error string")
    rows = parsed.where(F.col("error").isNull()).select("path", F.from_json("value", schema).alias("r")).select("path", "r.*")
    return rows, parsed.where(F.col("error").isNotNull()).select("path", "error")
