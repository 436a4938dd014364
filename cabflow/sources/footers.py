"""Per-file manifest from Parquet footers, read in parallel on executors.

The listing is a ``binaryFile`` scan that selects only ``path`` and
``length`` (the file content is never loaded); each task then opens its files
with pyarrow and reads the 4-byte magic at both ends and the footer. One
output row per *file*, so the Python work grows with the number of files, not
with their rows.

"Not Parquet" and "could not be read" are different things. The bytes are read
first, and any error of the store is raised; they are parsed from memory, and
any error of the parser marks that one file as not valid.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parquet magic bytes and the smallest possible valid file size.
PARQUET_MAGIC = b"PAR1"
MIN_PARQUET_BYTES = 12

FOOTER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("valid_parquet", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.IntegerType()),
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("signature", T.StringType()),
    ]
)


# Hadoop schemes that pyarrow knows by another name. Stores it cannot open at all need a
# caller's schema (``read_feed(..., schema=)``), or an entry in ``SCHEMES``.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _open(path: str):
    """pyarrow file system + in-filesystem path for a Hadoop-style URI."""
    from urllib.parse import unquote

    from pyarrow import fs as pafs

    scheme, sep, rest = path.partition(":")
    if not sep or scheme == "file":
        local = rest if sep else path
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), unquote(local)
    try:
        return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except Exception as e:
        raise OSError(
            f"footers of {scheme}: files cannot be read ({e}); name the store in footers.SCHEMES or pass a schema"
        ) from e


def _footer_bytes(path: str, length: int) -> bytes | None:
    """Magic, footer and magic of a file as one small Parquet file, None if it is not one by its magic."""
    fs, p = _open(path)
    with fs.open_input_file(p) as f:
        if length < MIN_PARQUET_BYTES:
            return None
        head, tail = f.read_at(4, 0), f.read_at(8, length - 8)
        if head != PARQUET_MAGIC or tail[4:] != PARQUET_MAGIC:
            return None
        size = int.from_bytes(tail[:4], "little")
        if size > length - MIN_PARQUET_BYTES:
            return None
        return head + f.read_at(size, length - 8 - size) + tail


def _facts(footer: bytes) -> tuple:
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    pf = pq.ParquetFile(pa.BufferReader(footer))
    schema = pf.schema_arrow
    # The Spark read schema of this file doubles as its group key.
    signature = from_arrow_schema(schema, prefer_timestamp_ntz=True).json()
    return pf.metadata.num_rows, len(schema), list(schema.names), signature


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for path, length in zip(pdf["path"], pdf["length"]):
            footer = _footer_bytes(path, int(length))  # errors of the store are raised
            facts = None
            if footer is not None:
                try:
                    facts = _facts(footer)
                except Exception:  # whatever a broken footer makes the parser raise
                    facts = None
            out.append((path, int(length), facts is not None, *(facts or (None,) * 4)))
        yield pd.DataFrame(out, columns=[f.name for f in FOOTER_SCHEMA.fields]).astype(
            {"rows": "Int64", "columns": "Int32"}
        )


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``path, length, mtime`` (ms) of every file under ``root`` matching ``glob`` (recursive)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", F.unix_millis("modificationTime").alias("mtime"))
    )


def footers(listing: DataFrame) -> DataFrame:
    """Footer facts per listed file (see ``FOOTER_SCHEMA``)."""
    return listing.select("path", "length").mapInPandas(_read_footers, FOOTER_SCHEMA)


# Directory layout <feed>/<year>/<file> under the lake root.
LAKE_LAYOUT = r"/(yellow|green)/(\d{4})/([^/]+)$"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per file: feed, year (from its directories), name, bytes, validity, rows, columns.

    Only footers that the catalogue of file versions does not have yet are opened.
    """
    from cabflow.sources.catalogue import facts

    f = facts(list_files(spark, root)).withColumnRenamed("length", "bytes")
    return f.select(
        F.regexp_extract("path", LAKE_LAYOUT, 1).alias("taxi_type"),
        F.regexp_extract("path", LAKE_LAYOUT, 2).cast("int").alias("year"),
        F.regexp_extract("path", LAKE_LAYOUT, 3).alias("file"),
        "bytes",
        "valid_parquet",
        "rows",
        "columns",
        "column_names",
        "signature",
        "path",
    )
