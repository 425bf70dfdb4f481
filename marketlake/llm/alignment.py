"""Alignment of two tokenizers' ids over the same bytes, by products of incidence matrices.

Each text is led by a space and encoded by a byte-level tokenizer (A) and a piece model (B); strings of special tokens
inside texts are plain text.  Rows of the incidence matrix A (and B) are tokens, columns the bytes that they cover, in compressed
sparse rows built here (`Csr`).  The row product A x B' (`Csr.multiply`, after Gustavson: each row of A gathers the rows of
B' that its columns name, and equal columns are summed) has an entry for each pair of tokens that overlap, worth the bytes
they share: the links.  Byte places where tokens of both end cut the text into groups; the product of the
matrices tokens x groups of A and B has an entry for each pair inside one group.

Both tokenizers are cut at the same places (see `units`), and those places are group borders, so a text's matrices are
block diagonal with one block a unit: products are taken once for each distinct unit of a worker.

Counts.  `linked` encodes each document once and writes its numbers, its digest and its distinct linked id pairs.  From that table
`pair_counts` counts in how many documents an id pair is linked, and `align` adds the counts up: pairs
that are in at least one of `FREQUENT` of all (document, pair) incidences, so at most that many, are sent to the tasks; all other
pairs of a document are joined to the table of counts.  The highest count of each A id (at most one number
for each id of the vocabulary) is sent too.

Null and empty texts, and texts whose joined token bytes are not the led text (U+2581, which the
piece model writes as a space), have no tokens: zeros and an empty digest.  Repeated rows count as often as they occur, in the
counts of documents too.  Equal counts all are highest.  An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import pick, prepare_python
from marketlake.llm.token_files import TOKENIZER_FILE, ByteTokenizer
from marketlake.llm.units import Pool, Store, cuts, encode_units, gathered, pieces, room, spans, text_buffers
from marketlake.session import checkpoint_dir

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"

#: At most so many id pairs are sent to the tasks.
FREQUENT = 1 << 20

#: Units kept by a worker, and bytes of text whose units are taken at once.
STORE = 1 << 19
PIECE_BYTES = 4 << 20

#: An id pair in one number.
SHIFT = 32


class Csr:
    """A sparse matrix in compressed rows."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    @classmethod
    def ranges(cls, first: np.ndarray, size: np.ndarray, width: int) -> Csr:
        """Row i has ones in the columns [first[i], first[i] + size[i])."""
        starts = np.concatenate([[0], np.cumsum(size)])
        return cls(starts, spans(first, size), np.ones(starts[-1], np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], self.values[order], len(self.starts) - 1)

    def multiply(self, other: Csr) -> Csr:
        """Row by row: every entry (i, k) takes row k of `other`, and equal columns of row i are added up."""
        size = np.diff(other.starts)[self.columns]
        taken = spans(other.starts[self.columns], size)
        rows, columns = np.repeat(self.rows(), size), other.columns[taken]
        values = np.repeat(self.values, size) * other.values[taken]
        key = rows * other.width + columns
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        summed = np.add.reduceat(values, new) if len(new) else values
        rows, columns = (rows[order][new], columns[order][new])
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(self.starts) - 1))])
        return Csr(starts, columns, summed, other.width)


class PieceTokenizer:
    """A SentencePiece model, made from the file's content in each worker."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(i) for i in ids]
        own = [None if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) else names[i].replace(SPACE, " ")
               for i in ids]
        if any(p and re.search("[^ ] |\n|[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]", p) for p in own):
            raise ValueError("a piece crosses the places where texts are cut")
        self.bytes_of = [bytes([int(n[1:-1], 16)]) if self.model.is_byte(i) else (p or "").encode()
                         for i, n, p in zip(ids, names, own)]
        self.size_of = np.array([len(b) for b in self.bytes_of], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the space which the model itself puts in front."""
        return self.model.encode([t[1:] for t in texts], num_threads=1)


def links(sizes_a: np.ndarray, ends_a: np.ndarray, sizes_b: np.ndarray, ends_b: np.ndarray) -> tuple[Csr, Csr, np.ndarray]:
    """(overlap links, shared-group links, group ends) of tokens with these byte sizes and ends over the same bytes."""
    width = int(ends_a[-1]) if len(ends_a) else 0
    overlap = Csr.ranges(ends_a - sizes_a, sizes_a, width).multiply(Csr.ranges(ends_b - sizes_b, sizes_b, width).transposed())
    groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
    one_a, one_b = np.ones(len(ends_a), np.int64), np.ones(len(ends_b), np.int64)
    grouped = Csr.ranges(np.searchsorted(groups, ends_a), one_a, len(groups)).multiply(
        Csr.ranges(np.searchsorted(groups, ends_b), one_b, len(groups)).transposed())
    return overlap, grouped, groups


class Aligner:
    """What is known of each distinct unit: numbers of tokens, groups and links, its linked id pairs, its groups as text."""

    COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")

    def __init__(self, tokenizer: str, model: bytes):
        self.a, self.b = ByteTokenizer(tokenizer, special_text=True), PieceTokenizer(model)
        self.forget()
        self.store = Store(self.learn, self.forget, STORE)

    def forget(self) -> None:
        self.numbers = np.zeros((1 << 10, len(self.COLUMNS)), np.int32)
        self.pairs, self.same, self.texts = Pool(np.int64), np.zeros(1 << 10, bool), []

    def learn(self, units: list[bytes]) -> None:
        """Encode the units by both, and take the products over all of them at once."""
        ids_a, count_a = encode_units(units, self.a.encode, self.a.size_of, b" a")
        ids_b, count_b = encode_units(units, self.b.encode, self.b.size_of, b" a")
        of_a, of_b = np.repeat(np.arange(len(units)), count_a), np.repeat(np.arange(len(units)), count_b)
        same = self._same_bytes(units, ids_b, count_b)
        keep_a, keep_b = same[of_a], same[of_b]
        ids_a, of_a, ids_b, of_b = ids_a[keep_a], of_a[keep_a], ids_b[keep_b], of_b[keep_b]
        sizes_a, sizes_b = self.a.size_of[ids_a], self.b.size_of[ids_b]
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        overlap, grouped, groups = links(sizes_a, ends_a, sizes_b, ends_b)
        n = len(units)
        n_links = np.bincount(of_a[overlap.rows()], minlength=n)
        unit_end = np.cumsum(np.where(same, [len(u) for u in units], 0))
        of_group = np.searchsorted(unit_end, groups)
        columns = (np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n), np.bincount(of_group, minlength=n), n_links,
                   np.bincount(of_a[grouped.rows()], minlength=n))
        known = len(self.texts)
        self.numbers, self.same = room(self.numbers, known + n), room(self.same, known + n)
        self.numbers[known:known + n] = np.stack(columns, axis=1)
        self.same[known:known + n] = same
        self.pairs.add((ids_a[overlap.rows()] << SHIFT) | ids_b[overlap.columns], n_links)
        self.texts += _group_texts(n, ids_a, ids_b, np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b), of_group)

    def _same_bytes(self, units: list[bytes], ids_b: np.ndarray, count_b: np.ndarray) -> np.ndarray:
        """Whether the pieces' bytes are the unit's (A's always are)."""
        ends = np.cumsum(count_b)
        flat = ids_b.tolist()
        return np.array([b"".join(map(self.b.bytes_of.__getitem__, flat[e - c:e])) == u
                         for u, e, c in zip(units, ends.tolist(), count_b.tolist())], bool)


def _group_texts(n: int, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray,
                 of_group: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;...` of each unit's groups."""
    def lists(of: np.ndarray, count: int, items: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(count + 1)).astype(np.int32)), items)

    def joined(ids: np.ndarray, group: np.ndarray) -> pa.Array:
        return pc.binary_join(lists(group, len(of_group), pa.array(ids).cast(pa.string())), ",")

    each = pc.binary_join_element_wise(joined(ids_a, group_a), joined(ids_b, group_b), "|")
    return pc.binary_join(lists(of_group, n, each), ";").cast(pa.binary()).to_pylist()


@lru_cache(maxsize=2)
def _aligner(tokenizer: str, model: bytes) -> Aligner:
    return Aligner(tokenizer, model)


def _files(spark: SparkSession, tokenizer_file: str, model_file: str):
    with open(tokenizer_file, encoding="utf-8") as f, open(model_file, "rb") as g:
        return spark.sparkContext.broadcast((f.read(), g.read()))


def _stretches(column: pa.Array, aligner: Aligner) -> list[tuple[np.ndarray, np.ndarray]]:
    """(unit numbers, text of each unit) of a column's texts, piece by piece."""
    aligner.store.renew()
    data, offsets = text_buffers(column, b" ")
    at = cuts(data, offsets)
    out = []
    for lo, hi in pieces(at, PIECE_BYTES):
        first, end = at[lo], at[hi]
        numbers = aligner.store.look_up(data[first:end], at[lo:hi + 1] - first)
        out.append((numbers, np.searchsorted(offsets, at[lo:hi], "right") - 1))
    return out


def _good_texts(stretches: list, n: int, aligner: Aligner) -> np.ndarray:
    """Whether each text's tokens give its bytes."""
    bad = np.zeros(n, bool)
    for numbers, texts in stretches:
        bad[texts[~aligner.same[numbers]]] = True
    return ~bad


def _distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of two columns, and how often each occurs."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(new)
    return left[at], right[at], np.diff(at, append=len(left))


def _document_pairs(stretches: list, good: np.ndarray, aligner: Aligner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, id pair, links) of the texts of a column: one row for each pair a text holds."""
    texts, pairs, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for numbers, of in stretches:
        keep = good[of]
        text, unit, count = _distinct(of[keep], numbers[keep])
        flat, size = aligner.pairs.take(unit)
        order_texts, weight = np.repeat(text, size), np.repeat(count, size)
        order = np.lexsort((flat, order_texts))
        order_texts, flat, weight = order_texts[order], flat[order], weight[order]
        new = np.ones(len(flat), bool)
        new[1:] = (order_texts[1:] != order_texts[:-1]) | (flat[1:] != flat[:-1])
        at = np.flatnonzero(new)
        texts.append(order_texts[at])
        pairs.append(flat[at])
        times.append(np.add.reduceat(weight, at) if len(at) else weight)
    if len(texts) == 2:
        return texts[1], pairs[1], times[1]
    text, pair, time = np.concatenate(texts), np.concatenate(pairs), np.concatenate(times)  # a text may go over several pieces
    order = np.lexsort((pair, text))
    text, pair, time = text[order], pair[order], time[order]
    new = np.ones(len(pair), bool)
    new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return text[at], pair[at], np.add.reduceat(time, at) if len(at) else time


def linked(docs: DataFrame, tokenizer_file: str = TOKENIZER_FILE, model_file: str = MODEL_FILE) -> DataFrame:
    """One row a document: doc_id, numbers of tokens, groups and links, the digest of its groups, and its linked id pairs.

    `pairs` holds each pair once, ascending, and `times` how often it is linked.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    files = _files(spark, tokenizer_file, model_file)
    rows = pick(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = Aligner.COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files.value)
        for batch in gathered(batches, PIECE_BYTES):
            n = batch.num_rows
            stretches = _stretches(batch.column(1), aligner)
            good = _good_texts(stretches, n, aligner)
            sums = {c: np.zeros(n, np.int64) for c in names}
            hashes = [None] * n
            for units, of in stretches:
                for c, values in zip(names, aligner.numbers[units].T):
                    sums[c] += np.bincount(of, values, n).astype(np.int64)
                texts = list(map(aligner.texts.__getitem__, units.tolist()))
                cut = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
                for k, lo, hi in zip(of[cut].tolist(), cut, [*cut[1:], len(of)]):
                    if good[k]:
                        stretch = b";".join(texts[lo:hi])
                        if hashes[k] is None:
                            hashes[k] = hashlib.sha256(stretch)
                        else:
                            hashes[k].update(b";" + stretch)
            for c in names:
                sums[c][~good] = 0
            text, pair, times = _document_pairs(stretches, good, aligner)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(sums[c]) for c in names], pa.array([h.hexdigest() if h else "" for h in hashes]),
                 pa.ListArray.from_arrays(ends, pa.array(pair)), pa.ListArray.from_arrays(ends, pa.array(times))],
                ["doc_id", *names, "groups_sha256", "pairs", "times"])

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names)
                           + ", groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n): the number of documents of `linked` that hold an id pair."""
    return found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _best(counts: DataFrame) -> dict[int, int]:
    """The highest count of each A id: at most one row for each id of the vocabulary."""
    return dict(map(tuple, counts.groupBy(F.expr(f"cast(shiftright(pair, {SHIFT}) as int)").alias("a")).agg(F.max("n").alias("n")).collect()))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(pairs, counts) of pairs in at least one of `most` incidences, ascending, and whether these are all."""
    total, rows = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), True
    table = counts.where(F.col("n").cast("decimal(38,0)") * most >= F.lit(total).cast("decimal(38,0)")).toArrow()
    pairs = table["pair"].to_numpy()
    order = np.argsort(pairs)
    return pairs[order], table["n"].to_numpy()[order], len(pairs) == rows


def align(found: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row a document of `found` (see `linked`): numbers of tokens, groups and links, links of the highest count, sum of counts, digest.

    `found` and `counts` (see `pair_counts`) are read several times: pass written tables.
    """
    spark = found.sparkSession
    prepare_python(spark)
    pairs, numbers, whole = _frequent(counts, frequent)
    best = _best(counts)
    top = np.zeros(max(best, default=0) + 1, np.int64)
    top[list(best)] = list(best.values())
    known = spark.sparkContext.broadcast((pairs, numbers, top))
    own = ["doc_id", *Aligner.COLUMNS, "groups_sha256"]
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, top = known.value
        for batch in batches:
            n = batch.num_rows
            lists, weights = batch.column(len(own)), batch.column(len(own) + 1)
            text = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            pair, times = lists.flatten().to_numpy(), weights.flatten().to_numpy()
            place = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            hit = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)
            count = numbers[place[hit]]
            n_best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(n_best, text[hit], times[hit] * (count == top[pair[hit] >> SHIFT]))
            np.add.at(total, text[hit], times[hit] * count)
            rare = ~hit
            ends = np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=n))]).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(pair[rare]), pa.array(times[rare])], ["pair", "times"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(own)], pa.array(n_best), pa.array(total), rest],
                                             [*own, "n_best", "count_sum", "rest"])

    scored = found.select(*own, "pairs", "times").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in Aligner.COLUMNS)
        + ", groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,times:long>>")
    if whole:
        return scored.drop("rest")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    scored = spark.read.parquet(folder)
    top_counts = counts.withColumn("a", F.expr(f"cast(shiftright(pair, {SHIFT}) as int)"))
    highest = spark.createDataFrame([(int(a), int(m)) for a, m in best.items()], "a int, top long")
    rest = scored.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.times")
    more = rest.join(top_counts, "pair").join(F.broadcast(highest), "a").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return scored.drop("rest").join(more, "row", "left").select(
        *own, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def alignment_query(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The contract's columns for `op12_tokenizer_alignment`, and n_shared, the pairs inside one group."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    linked(docs).write.option("compression", "zstd").parquet(f"{folder}/linked")
    found = spark.read.parquet(f"{folder}/linked")
    pair_counts(found).write.parquet(f"{folder}/pairs")
    return align(found, spark.read.parquet(f"{folder}/pairs"), frequent)
