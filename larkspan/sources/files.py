"""File sources: typed CSV, drifting schemas, file listings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File extension to content type.
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "png": "image/png",
    "jpg": "image/jpeg",
    "mp3": "audio/mpeg",
    "txt": "text/plain",
    "csv": "text/csv",
    "html": "text/html",
    "json": "application/json",
    "parquet": "application/vnd.apache.parquet",
}
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """CSV with a header, quoted fields (line feeds included) and empty strings as NULL.

    A quoted line feed needs whole files, so a file is one split: export many files of moderate size. Rows that do not fit the schema keep their raw text in `_corrupt_record`.
    """
    full = T.StructType(T._parse_datatype_string(schema).fields + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).options(
        header=True, quote='"', escape='"', nullValue="", multiLine=True, mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    return reader.options(**options).csv(path)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rejected raw lines) of a table loaded by `read_csv`."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def conform(df: DataFrame, schema: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Bring a drifted table to the target schema: rename, add missing as NULL, cast."""
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    cols = []
    for field in T._parse_datatype_string(schema).fields:
        present = field.name in df.columns
        source = F.col(field.name) if present else F.lit(None)
        cols.append(source.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as rows: path below `path`, size, last modification. File bytes are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path).rstrip("/") + "/"
    name = F.substring_index("path", root, -1)
    return df.select(
        name.alias("relative_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.col("path").alias("file_url"),
    )


def extension(path: Column) -> Column:
    return F.lower(F.substring_index(path, ".", -1))


def content_type(path: Column) -> Column:
    ext = extension(path)
    out = F.lit("application/octet-stream")
    for key, mime in CONTENT_TYPES.items():
        out = F.when(ext == key, F.lit(mime)).otherwise(out)
    return out
