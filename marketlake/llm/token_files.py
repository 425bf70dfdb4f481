"""Token ids as Parquet list columns that can be read in part.

Documents are ordered by (doc_id, hash of the text) over the cluster and encoded once, behind that
shuffle; each task writes one file of them.  A file's columns are doc_id, shard (its number in the order), local_start (ids
before the document in its file), n_tokens and ids.  ids keep a dictionary (16-bit codes for a vocabulary of
50,000); doc_id and local_start rise within a file and are delta encoded.  Row groups and pages are bounded by
parameters, and pages carry indexes, so readers of some documents, or of a stretch of the id stream, fetch the pages
that hold them, and readers of metadata no ids at all.  Beside the files stands `shards`: one row a file with its number of documents
and ids and the ids before it, made from the metadata columns alone.

Texts are cut into units (see `units`); the tokenizers library encodes each distinct one, which gives
the ids of the whole text.  Strings of special tokens inside a text are taken as the library takes them by
default: as the special token.  `end_id` follows each document.

Null and empty texts have the end id alone.  Null ids stand first.  Equal ids are ordered by text hash, and equal
rows are spread over the tasks like any others.  An empty table gives empty files; further columns are not read.  A very long text
is encoded piece by piece, but its ids are one row.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import pick, prepare_python
from marketlake.llm.units import Pool, Store, cuts, encode_units, gathered, pieces, text_buffers
from marketlake.session import checkpoint_dir

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 2
ROW_GROUP_BYTES = 64 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2048
PIECE_BYTES = 8 << 20


def byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level tokenizers write: visible Latin-1 characters stand for
    themselves, the other bytes in ascending order for the characters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """A byte-level tokenizer of the tokenizers library, made from the file's content in each worker."""

    def __init__(self, content: str, special_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = special_text
        byte = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.added = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = self.added[i] if i in self.added else bytes(byte[c] for c in token)
        self.size_of = np.array([len(b) for b in self.bytes_of], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class UnitIds:
    """Ids of texts by way of their units."""

    def __init__(self, tokenizer: ByteTokenizer):
        self.tokenizer = tokenizer
        self.forget()
        self.store = Store(self.learn, self.forget)

    def forget(self) -> None:
        self.pool = Pool(np.int32)

    def learn(self, units: list[bytes]) -> None:
        self.pool.add(*encode_units(units, self.tokenizer.encode, self.tokenizer.size_of, b""))

    def encode(self, column: pa.Array, piece_bytes: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        data, offsets = text_buffers(column)
        at = cuts(data, offsets)
        flats, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo, hi in pieces(at, piece_bytes):
            first, end = at[lo], at[hi]
            self.store.renew()
            numbers = self.store.look_up(data[first:end], at[lo:hi + 1] - first)
            flat, size = self.pool.take(numbers)
            flats.append(flat)
            sizes.append(size)
        through = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.concatenate(flats), np.diff(through[np.searchsorted(at, offsets)])


@lru_cache(maxsize=2)
def _unit_ids(content: str) -> UnitIds:
    return UnitIds(ByteTokenizer(content))


def encode_ordered(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, shard, local_start, n_tokens, ids) of all documents, ordered within and across partitions."""
    spark = docs.sparkSession
    prepare_python(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, encoder = 0, _unit_ids(content.value)
        for batch in gathered(batches):
            flat, sizes = encoder.encode(batch.column(1))
            ends = np.cumsum(sizes + 1)
            ids = np.full(ends[-1], end_id, np.int32)
            keep = np.ones(len(ids), bool)
            keep[ends - 1] = False
            ids[keep] = flat
            starts = before + ends - (sizes + 1)
            before += int(ends[-1])
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(starts), pa.array(sizes + 1),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                ["doc_id", "shard", "local_start", "n_tokens", "ids"])

    rows = pick(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("tie"),
                                               F.monotonically_increasing_id().alias("row"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "tie", "row")
    ordered = dealt.sortWithinPartitions("doc_id", "tie").select("doc_id", "text", F.spark_partition_id().alias("shard"))
    return ordered.mapInArrow(run, f"doc_id {kind}, shard int, local_start long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str = TOKENIZER_FILE, end_id: int = END_ID,
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> None:
    """Write `folder`/tokens and `folder`/shards."""
    writer = encode_ordered(docs, tokenizer_file, end_id).write.option("compression", "zstd")
    settings = {"parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows,
                "parquet.writer.version": "v2", "parquet.enable.dictionary": "true",
                "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#local_start": "false"}
    writer.options(**settings).parquet(f"{folder}/tokens")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{folder}/tokens").groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    start, rows = 0, []
    for shard, n_docs, n_tokens in sorted(tuple(r) for r in sizes.collect()):  # one row a file
        rows.append((shard, start, n_docs, n_tokens))
        start += n_tokens
    spark.createDataFrame(rows, "shard int, start long, n_docs long, n_tokens long").coalesce(1).write.parquet(f"{folder}/shards")


def shard_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids before each file: one number a file."""
    return {r.shard: r.start for r in spark.read.parquet(f"{folder}/shards").select("shard", "start").collect()}


def read_tokens(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """The named columns of the files, with `start` (ids of all documents before) among them if wanted.

    Only the files' columns that are asked for are read; filters on doc_id reach the files' page indexes.
    """
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "start")
    tokens = spark.read.parquet(f"{folder}/tokens")
    if "start" in columns:
        tokens = tokens.join(shards, "shard").withColumn("start", F.col("start") + F.col("local_start"))
    return tokens.select(*columns)


def read_stretch(spark: SparkSession, folder: str, first: int, end: int) -> DataFrame:
    """(doc_id, start, ids) of the documents' ids at places [first, end) of the whole stream.

    Files outside are not opened for more than their footers.
    """
    shards = spark.read.parquet(f"{folder}/shards").where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > first))
    low, high = shards.agg(F.min("shard"), F.max("shard")).first()
    tokens = spark.read.parquet(f"{folder}/tokens").where(F.col("shard").between(F.lit(low), F.lit(high)))
    rows = tokens.join(shards.select("shard", "start"), "shard").withColumn("start", F.col("start") + F.col("local_start"))
    rows = rows.where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > first))
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    take = F.least(F.lit(end) - F.col("start"), F.col("n_tokens")) - skip
    return rows.select("doc_id", (F.col("start") + skip).alias("start"),
                       F.slice("ids", (skip + 1).cast("int"), take.cast("int")).alias("ids"))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    prepare_python(spark)
    starts = shard_starts(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            view = memoryview(flat).cast("B")
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(ends, ends[1:])]
            shift = np.array([starts[s] for s in batch.column(1).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(batch.column(2).to_numpy() + shift), batch.column(3), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(f"{folder}/tokens").select("doc_id", "shard", "local_start", "n_tokens", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_file_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op11_token_files`: documents written as token files, digests of what is read back."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_tokens(docs, folder)
    return digests(spark, folder)
