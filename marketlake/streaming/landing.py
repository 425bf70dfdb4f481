"""availableNow file stream: landing CSV -> bronze parquet (append, exactly once)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.sources.catalog import SOURCES, bronze_schema
from marketlake.sources.csv import CORRUPT
from marketlake.sources.lake import Lake
from marketlake.sources.sinks import exists


def land_new_files(spark: SparkSession, landing: str, bronze_dir: str, name: str,
                   pattern: str | None = None, max_files_per_trigger: int | None = None,
                   checkpoint: str | None = None) -> int:
    """Append the rows of not-yet-landed CSV files of source `name` to its
    bronze folder; return the number of rows landed by this run.

    Each landed row carries `_source_file` (from the file metadata column) so
    lineage back to the landing file is kept.  The stream's progress stands beside the
    target table by default, so every process that lands there goes on from it.  A file whose header
    is not the declared one is an error.  A folder that `ingest_bronze` wrote is refused.
    """
    src = SOURCES[name]
    schema = StructType([*bronze_schema(name).fields, StructField(CORRUPT, StringType())])
    reader = (spark.readStream.schema(schema)
              .option("header", "true").option("enforceSchema", "false")
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", pattern or f"*{src.file_name}"))
    for key, value in src.options.items():
        reader = reader.option(key, value)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(landing).withColumn("_source_file", F.col("_metadata.file_name"))
    target = f"{bronze_dir.rstrip('/')}/{name}"
    owned = exists(spark, f"{target}/_spark_metadata")
    seen = Lake(spark, bronze_dir).commit()
    if not owned and (exists(spark, target) or name in seen.tables or seen.parts(name)):
        raise ValueError(f"{target} belongs to a full ingest or to landing with a ledger")
    landed = spark.read.schema(schema).parquet
    before = landed(target).count() if owned else 0
    ckpt = checkpoint or f"{bronze_dir.rstrip('/')}/_landing/{name}"
    query = (stream.writeStream.format("parquet")
             .option("checkpointLocation", ckpt)
             .option("path", target)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    # counted in the table: the query keeps only its last updates
    return (landed(target).count() if exists(spark, f"{target}/_spark_metadata") else 0) - before
