"""Landing with a ledger: only files that are new or changed are read, and only their rows are replaced.

`land_changed` makes the bronze tables equal to a fresh ingest of the landing folder.  The ledger, a table of the bronze
folder, has one row for each landed file: size, time of change, number of rows, and an order-free digest of the rows.  A landing

1. joins the listing of the folder (file metadata only) with the ledger: files are new, changed (another size or time), unchanged or gone;
2. reads the new and changed files of each source in one job and writes their rows as parts, one a file (`lake.write_parts`);
3. publishes the new parts, the parts that stay and the new ledger in one commit.

Unchanged files are not read, and their parts are neither read nor written again.  Readers see the landing whole or not at all, and one that
fails or is killed is repeated by the next one, which finds the same ledger.

A file of a source is one whose name, or that of a folder above it below the landing folder, ends with the source's file name,
or with that name and `.gz` (compressed).  All files that
a landing reads of a source have one header; a source with a file of another header, or without a declared column, fails
as a whole: its rows stay as they were, its files are tried again by the next landing, and the other sources land.  Files that are gone lose their
rows, unless no file of their source is left (as with a fresh ingest, a missing source keeps its table).  A file
that is changed within the resolution of the file system's clock and keeps its size is not seen as changed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.sources.catalog import SOURCES, bronze_schema
from marketlake.sources.csv import CORRUPT, read_files
from marketlake.sources.lake import Commit, Lake
from marketlake.sources.sinks import exists

LEDGER = "_ledger"
FILE = "_source_file"

_LEDGER = "source string, file string, bytes long, modified timestamp, rows long, corrupt_rows long, digest string"
_REPORT = "source string, file string, state string, rows long, corrupt_rows long, error string"


def list_files(spark: SparkSession, landing: str, files: Mapping[str, str]) -> DataFrame:
    """(source, file, path, bytes, modified) of every CSV file below the landing folder; no content is read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(landing)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    names = F.split(F.substring("path", len(root) + 1, 1 << 30), "/")

    def named(end: str) -> Column:
        return F.exists(names, lambda part: part.endswith(end) | part.endswith(f"{end}.gz"))

    source = F.coalesce(*[F.when(named(end), F.lit(source)) for source, end in files.items()])
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,csv.gz}").load(landing))
    return found.select(source.alias("source"), F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("bytes"),
                        F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, bronze_dir: str, commit: Commit | None = None, fmt: str = "parquet") -> DataFrame:
    """One row for each landed file, as of a commit (the latest if not given)."""
    lake = Lake(spark, bronze_dir, fmt)
    commit = commit or lake.commit()
    return lake.read(LEDGER, commit) if LEDGER in commit.tables else spark.createDataFrame([], _LEDGER)


def read_landed(spark: SparkSession, bronze_dir: str, name: str, commit: Commit | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of a source's landed files, with the file of each row; empty if no file has rows."""
    lake = Lake(spark, bronze_dir, fmt)
    commit = commit or lake.commit()
    if not commit.parts(name):
        extra = [StructField(CORRUPT, StringType()), StructField(FILE, StringType())]
        return spark.createDataFrame([], StructType([*bronze_schema(name).fields, *extra]))
    return lake.read_parts(name, commit)


def _literal(path: str) -> str:
    """A path whose wildcard characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _file_stats(rows: DataFrame) -> DataFrame:
    """Rows, rows that did not parse, and a digest that depends on the rows but not on their order, for each file."""
    columns = [c for c in rows.columns if c != FILE]
    h = F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    parts = [F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftrightunsigned(h, 32)), F.bit_xor(h)]
    return rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("corrupt_rows"),
                                  F.concat_ws(":", *[p.cast("string") for p in parts]).alias("digest"))


def land_changed(spark: SparkSession, landing: str, bronze_dir: str, files: Mapping[str, str] | None = None,
                 fmt: str = "parquet", parallel: int = 4) -> DataFrame:
    """Bring the bronze tables up to the landing folder; returns one row a file: source, file, state, rows, corrupt_rows, error.

    States: `new`, `replaced` (other rows than before), `rewritten` (changed, but the same rows), `unchanged`, `removed`, `kept` (gone, but
    its source has no file left), `failed`, `skipped` (of no declared source).  One row for each new, changed or gone file
    reaches the driver, which names those files to the readers.  A bronze folder that a full ingest or the file stream writes is refused.
    """
    from concurrent.futures import ThreadPoolExecutor

    names = {name: (files or {}).get(name, src.file_name) for name, src in SOURCES.items()}
    lake = Lake(spark, bronze_dir, fmt)
    refresh = lake.refresh()
    base = refresh.base
    for name in names:
        if name in base.tables or exists(spark, f"{lake.root}/{name}/_spark_metadata"):
            raise ValueError(f"{lake.root}/{name} belongs to a full ingest or to the file stream")
    listing = list_files(spark, landing, names)
    ledger = read_ledger(spark, bronze_dir, base, fmt)
    old = ledger.select("source", "file", *[F.col(c).alias(f"old_{c}") for c in ("bytes", "modified", "rows", "corrupt_rows", "digest")])
    same = (F.col("bytes") == F.col("old_bytes")) & (F.col("modified") == F.col("old_modified"))
    compared = listing.join(old, ["source", "file"], "full_outer").withColumn(
        "state", F.when(F.col("source").isNull(), "skipped").when(F.col("bytes").isNull(), "gone").when(F.col("old_bytes").isNull(), "new").when(same, "unchanged").otherwise("changed"))
    # What runs later must see the files as they were listed now, so the comparison is a table of this refresh.
    compared = refresh.write("_compared", compared)
    moved = compared.where("state not in ('unchanged', 'skipped')").collect()
    present = {r[0] for r in compared.where("state not in ('gone', 'skipped')").select("source").distinct().collect()}
    changed = {name: [r for r in moved if r.source == name and r.state != "gone"] for name in names}

    def land(item):
        name, todo = item
        try:
            rows = read_files(spark, name, [_literal(r.path) for r in todo], file_column=FILE)
            written = refresh.write_parts(name, rows, F.md5(FILE))
            return name, {r[FILE]: r for r in _file_stats(written).collect()} if written is not None else {}, None
        except Exception as exc:  # noqa: BLE001 - report and continue
            return name, {}, str(exc).splitlines()[0][:500]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        landed = list(pool.map(land, [(n, todo) for n, todo in changed.items() if todo]))
    failed = {n for n, _, error in landed if error}

    report, records, parts, without = [], [], [], []
    for name, stats, error in landed:
        for r in changed[name]:
            if error:
                report.append((name, r.file, "failed", None, None, error))
                continue
            found = stats.get(r.file)
            count, corrupt, digest = (found["rows"], found["corrupt_rows"], found["digest"]) if found else (0, 0, "")
            state = "new" if r.state == "new" else "rewritten" if digest == r.old_digest else "replaced"
            report.append((name, r.file, state, count, corrupt, None))
            records.append((name, r.file, r.bytes, r.modified, count, corrupt, digest))
            (parts if found else without).append((name, r.file))
    gone = [r for r in moved if r.state == "gone"]
    removed = [r for r in gone if r.source in present and r.source not in failed]
    without += [(r.source, r.file) for r in removed]
    report += [(r.source, r.file, "removed" if r in removed else "kept", None if r in removed else r.old_rows,
                None if r in removed else r.old_corrupt_rows, None) for r in gone]

    replaced = spark.createDataFrame([(s, f) for s, f, *_ in records] + [(r.source, r.file) for r in removed], "source string, file string")
    fresh = spark.createDataFrame(records, _LEDGER)
    refresh.write(LEDGER, ledger.join(replaced, ["source", "file"], "left_anti").unionByName(fresh))
    refresh.commit(only=[LEDGER], parts=[(n, _part(f)) for n, f in parts], without=[(n, _part(f)) for n, f in without])

    rest = compared.where("state in ('unchanged', 'skipped')").select(
        "source", "file", "state", F.col("old_rows").alias("rows"), F.col("old_corrupt_rows").alias("corrupt_rows"),
        F.when(F.col("state") == "skipped", F.lit("no declared source")).alias("error"))
    return spark.createDataFrame(report, _REPORT).unionByName(rest)


def _part(file: str) -> str:
    """The name of a file's part."""
    return hashlib.md5(file.encode()).hexdigest()
