"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import marketlake
from marketlake.session import checkpoint_dir

_SHIPPED: set[str] = set()

#: One word: a run of anything but the six ASCII white-space characters (Java and Python syntax).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at once inside a task; longer texts are walked in pieces of this size.
PIECE_BYTES = 1 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the named columns, whatever else the table has.

    Columns are taken by position, so further columns whose names differ only
    in case, or repeat a name (the first wins), cause no ambiguity.
    """
    by = positional(df)
    return by.select(*[by[f"c{df.columns.index(n)}"].alias(n) for n in names])


def positional(df: DataFrame) -> DataFrame:
    """`df` with its columns named c0, c1, ...: no two clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def prepare_python(spark: SparkSession, rows: int = 512) -> None:
    """Make the package known to the executors' Python workers, and keep Arrow batches small.

    Small batches bound a worker's memory when long texts follow each other.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        home = os.path.dirname(os.path.dirname(os.path.abspath(marketlake.__file__)))
        archive = shutil.make_archive(os.path.join(os.path.realpath(tempfile.mkdtemp()), "marketlake_package"), "zip", home, "marketlake")
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt anew over all shuffle partitions: for few rows that each make many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder: lineage is cut, lost executors lose nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a compressed table in the shared checkpoint folder, read back: smaller than `checkpointed`, but dealt anew when it is read."""
    spark = df.sparkSession
    place = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def step(df: DataFrame) -> DataFrame:
    """`checkpointed`, for the steps of long iterations.

    Spark frees the shuffles, broadcasts and compiled plans of ended jobs when the driver's garbage collector finds their handles
    unused.  A driver with hundreds of small jobs collects late, so its memory, and the executors' disks, grow with the
    number of steps; here it collects after each one.
    """
    out = checkpointed(df)
    df.sparkSession._jvm.System.gc()
    return out


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod `modulus`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def byte_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def word_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of `data` in order, as lists from pieces of about `size` bytes.

    `bytes.split()` splits at exactly the six ASCII white-space characters.  A
    piece ends after the first white space from `size` bytes on.
    """
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end
