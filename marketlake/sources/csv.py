"""CSV readers for the landing folder (header row, explicit string schema)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marketlake.sources.catalog import SOURCES
from marketlake.sources.ranges import read_csv


#: Bronze column that keeps the raw text of a row with too few or too many fields; null for good rows.
CORRUPT = "_corrupt_record"


def read_bronze(spark: SparkSession, folder: str, name: str,
                file_name: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """Read one landing CSV as its all-string bronze frame, columns found by header name.

    A missing column is an error; further columns are left out.  Rows with too few or too many fields stay, with
    their raw text in `_corrupt_record`.  Plain CSVs are split by Spark's
    reader; multi-line CSVs (reviews), which that reader takes one task a file, are read by byte ranges
    (`ranges.read_csv`; `range_bytes` bounds them, the session's split size if not given).
    """
    return read_files(spark, name, f"{folder.rstrip('/')}/{file_name or SOURCES[name].file_name}", range_bytes)


def read_files(spark: SparkSession, name: str, path: str | list[str], range_bytes: int | None = None,
               file_column: str | None = None) -> DataFrame:
    """The bronze frame of one source from files or folders that have one header; `file_column` names each row's file."""
    src = SOURCES[name]

    def reader():
        out = spark.read.option("header", "true").option("mode", "PERMISSIVE")
        for key, value in src.options.items():
            out = out.option(key, value)
        return out

    header = reader().csv(path).columns
    if missing := [c for c in src.columns if c not in header]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    if src.options.get("multiLine") == "true":
        rows = read_csv(spark, path, header, src.options, corrupt=CORRUPT, range_bytes=range_bytes, file_column=file_column)
        return rows.select(*src.columns, CORRUPT, *([file_column] if file_column else []))
    schema = StructType([StructField(c, StringType()) for c in [*header, CORRUPT]])
    return (reader().schema(schema).option("enforceSchema", "false").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path).select(*src.columns, CORRUPT, *([F.col("_metadata.file_path").alias(file_column)] if file_column else [])))


def read_bronze_all(spark: SparkSession, folder: str,
                    files: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """All nine bronze frames; `files` maps source name to a non-default file name."""
    files = dict(files or {})
    return {name: read_bronze(spark, folder, name, files.get(name)) for name in SOURCES}


_LANDING_SCHEMA = StructType([
    StructField("file_name", StringType(), True),
    StructField("bytes", LongType(), True),
    StructField("status", StringType(), True),
])


def discover_landing(spark: SparkSession, folder: str) -> DataFrame:
    """List `*.csv` files in a landing folder: (file_name, bytes, status).

    Uses the binary-file source with the content column pruned, so only file
    metadata is read.  A missing or empty folder yields one row with status
    `missing` / `empty` instead of an exception.
    """
    try:
        files = (spark.read.format("binaryFile")
                 .option("pathGlobFilter", "*.csv")
                 .load(folder)
                 .select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                         F.col("length").alias("bytes"),
                         F.lit("found").alias("status")))
    except Exception as exc:  # noqa: BLE001 - the reader raises AnalysisException
        status = "missing" if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) else "error"
        return spark.createDataFrame([(None, None, status)], _LANDING_SCHEMA)
    if files.isEmpty():
        return spark.createDataFrame([(None, None, "empty")], _LANDING_SCHEMA)
    return files
