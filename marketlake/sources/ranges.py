"""Quoted, multi-line CSV read by byte ranges: one large file is many tasks.

A line break inside quotes is not a record's end, so a range of a file does not know where its records start: that
depends on whether its first byte lies inside quotes, which all the text before decides.  It is a prefix scan
over two states:

1. Summaries.  Each range (an input split of Spark's text source, whole physical lines) reports, in one row, whether it has an
   odd number of quotes, and whether a record ends in it if it is entered inside quotes (entered outside, its
   first line starts a record).
2. Combination.  Parities add up, so the summaries of a file, in order, give each range's state at its entry, and the
   range in which the record starts that is open there.  This is one small entry a range, as many as the scheduler has tasks.
3. Records.  Each range cuts its lines into records on its own.  Only the pieces of records that cross ranges are
   grouped (by file and the range where they start) and joined; everything else stays in its task.

Records are then parsed by Spark (`from_csv`) with the declared options, in the JVM.

Quotes must be as in RFC 4180: a quote inside a quoted field is doubled, and fields that are not quoted hold none.  A file whose
last record does not close is an error.  A record ends with LF or CRLF; blank lines between records are skipped, as
Spark's reader does.  Line breaks inside quotes stay as they are.  Compressed files that cannot be split are one range each: if all
are, no state needs to be known before, and steps 1 and 2 are left out.  Records are grouped only if some cross ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Range = tuple[str, int]

#: Ends of the names of compressed files that Spark does not split.
WHOLE_FILES = (".gz",)


def _lines(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    """(file, start, value): physical lines, in order within each input split (file, start)."""
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Range, pa.Array, np.ndarray]]:
    """((file, start), lines, quotes of each line) for the parts of each batch that belong to one range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, value = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
        code = file.dictionary_encode()
        number = code.indices.to_numpy()
        cut = np.flatnonzero((np.diff(start) != 0) | (np.diff(number) != 0)) + 1
        quotes = pc.count_substring(value, '"').to_numpy()
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            yield (code.dictionary[int(number[a])].as_py(), int(start[a])), value.slice(a, b - a), quotes[a:b]


def range_states(lines: DataFrame, quote: str = '"') -> dict[Range, tuple[bool, int]]:
    """For each range: whether it is entered inside quotes, and the start of the range where the record begins that is open there.

    One row a range reaches the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[Range, list] = {}
        for key, _, quotes in _stretches(batches):
            state = found.setdefault(key, [0, False])
            through = (state[0] + np.cumsum(quotes)) % 2
            state[1] = state[1] or bool((through == 1).any())   # entered inside, an odd count is outside
            state[0] = int(through[-1])
        if found:
            yield pa.RecordBatch.from_pydict({"file": [k[0] for k in found], "start": [k[1] for k in found],
                                              "odd": [v[0] for v in found.values()], "closes": [v[1] for v in found.values()]})

    rows = lines.mapInArrow(run, "file string, start long, odd long, closes boolean").collect()
    states: dict[Range, tuple[bool, int]] = {}
    file, inside, owner = None, False, 0
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            if inside:
                raise ValueError(f"{file}: the last record has an open quote")
            file, inside, owner = r.file, False, r.start
        states[r.file, r.start] = (inside, owner)
        if not inside or r.closes:
            owner = r.start       # a record that is open at the end starts here
        inside ^= bool(r.odd)
    if inside:
        raise ValueError(f"{file}: the last record has an open quote")
    return states


_PIECES = "file string, owner long, start long, first boolean, whole boolean, record string"


def _pieces(lines: DataFrame, states: dict[Range, tuple[bool, int]] | None) -> DataFrame:
    """(file, owner, start, first, whole, record): whole records, and the parts of those that cross ranges, with the range they start in.

    Without `states`, each range is a whole file, and a record that is open at its end is an error.
    """
    sent = lines.sparkSession.sparkContext.broadcast(states)

    def rows(key: Range, owner: int, whole: bool, first: list[bool], records: list) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array([owner] * n, pa.int64()), pa.array([key[1]] * n, pa.int64()),
             pa.array(first, pa.bool_()), pa.array([whole] * n, pa.bool_()), pa.array(records, pa.string())],
            ["file", "owner", "start", "first", "whole", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, owner, head, fresh, held = None, False, 0, False, False, []

        def rest() -> Iterator[pa.RecordBatch]:
            if held and sent.value is None:
                raise ValueError(f"{key[0]}: the last record has an open quote")
            if held:                                   # goes on in the next range
                yield rows(key, owner if head else key[1], False, [fresh], ["\n".join(held)])

        for own, value, quotes in _stretches(batches):
            if own != key:
                yield from rest()
                key, held = own, []
                inside, owner = (False, own[1]) if sent.value is None else sent.value[own]
                head, fresh = inside, own[1] == 0 and not inside     # head: the open record started before this range
            through = (inside + np.cumsum(quotes)) % 2
            ends = np.flatnonzero(through == 0)
            inside = bool(through[-1])
            if not len(ends):
                held += value.to_pylist()
                continue
            at = 0
            if held or head:
                record = "\n".join([*held, *value.slice(0, ends[0] + 1).to_pylist()])
                yield rows(key, owner if head else key[1], not head, [fresh], [record])
                held, head, fresh, at, ends = [], False, False, int(ends[0]) + 1, ends[1:]
            if len(ends):
                offsets = np.concatenate([[0], ends + 1 - at]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), value.slice(at, int(ends[-1]) + 1 - at))
                records = pc.binary_join(lists, "\n").to_pylist()
                yield rows(key, key[1], True, [fresh, *[False] * (len(records) - 1)], records)
                fresh, at = False, int(ends[-1]) + 1
            held = value.slice(at).to_pylist()
        yield from rest()

    return lines.mapInArrow(run, _PIECES)


def _trimmed(records: DataFrame) -> DataFrame:
    """Records without the CR of a CRLF end, and without blank lines; only records with a CR are searched for one at the end."""
    record = F.when(F.col("record").contains("\r"), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record"))
    return records.withColumn("record", record).where(F.col("record") != "")


def read_records(spark: SparkSession, path: str | list[str], pattern: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """(file, first, record): the records of quoted CSV files as text; first: the first record of its file (the header).

    `range_bytes` bounds the ranges of this read (the session's `spark.sql.files.maxPartitionBytes` if not given).
    The summaries are taken when this is called (none are needed if no file can be split); the records when the result runs, from the same ranges.
    """
    if range_bytes:
        spark = spark.newSession()
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    lines = _lines(spark, path, pattern)
    states = None if all(f.endswith(WHOLE_FILES) for f in lines.inputFiles()) else range_states(lines)
    pieces = _pieces(lines, states)
    whole = pieces.where("whole").select("file", "first", "record")
    if not any(inside for inside, _ in (states or {}).values()):
        return _trimmed(whole)
    crossing = pieces.where("not whole").groupBy("file", "owner").agg(
        F.max("first").alias("first"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "\n").alias("record"))
    joined = crossing.select("file", "first", "record")
    return _trimmed(whole.unionByName(joined))


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], options: dict[str, str] | None = None, pattern: str | None = None,
             corrupt: str | None = None, range_bytes: int | None = None, file_column: str | None = None) -> DataFrame:
    """The string columns (in file order) of quoted, multi-line CSV files with a header line, read by ranges.

    A file with another header is an error.  With `corrupt`, rows with too few or too many fields keep their raw text in that column;
    `file_column` names the file of each row.
    """
    records = read_records(spark, path, pattern, range_bytes)
    names = [*columns, *([corrupt] if corrupt else [])]
    schema = ", ".join(f"`{c}` string" for c in names)
    settings = {"quote": '"', "escape": '"', **(options or {}), "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt:
        settings["columnNameOfCorruptRecord"] = corrupt
    rows = records.select("file", "first", F.from_csv("record", schema, settings).alias("r"))
    wrong = F.raise_error(F.concat(F.lit(f"header is not {','.join(columns)}: "), "file")).cast("boolean")
    same = F.array(*[F.col("r").getField(c) for c in columns]) == F.array(*[F.lit(c) for c in columns])
    own = rows.where(F.when(~F.col("first"), F.lit(True)).when(same, F.lit(False)).otherwise(wrong))
    return own.select(*[F.col("r").getField(c).alias(c) for c in names], *([F.col("file").alias(file_column)] if file_column else []))
