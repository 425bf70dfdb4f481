"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Fitting uses at most `SAMPLE` labelled documents (those with the smallest hash of their id; a documented
bound for fitting only).  Their terms (words, word shapes, pairs of shapes, repeats) are hashed into
`TERMS` columns, weighted by tf-idf, and projected on the first singular directions,
shape terms and word terms apart.  The labelled vectors and the projection are what is broadcast: their size is
fixed by `SAMPLE`, `TERMS` and `RANK` (5 MB and 17 MB).

Scoring is exact: each block of documents is multiplied with all labelled vectors, and the
`NEIGHBOURS` most similar vote with their similarity's `SHARP`-th power.  The score is the
weighted share of label 1.

Null and empty texts and texts without known terms have no direction; their score is the sample's share of
label 1 (0.5 without labels).  Repeated labels of an id count once, by the larger.  A null id is a
training row, but has no label.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import byte_values, pick, prepare_python, remainder, word_pieces

SAMPLE = 8192
TERMS = 1 << 15
RANK = 64
NEIGHBOURS = 48
SHARP = 8
SHAPE_WEIGHT = 0.8
SEED = 42

#: Words whose terms a worker remembers; beyond, the memory starts anew.
MEMORY = 300_000

_SHAPE = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"))
_HALF = TERMS // 2


class Terms:
    """Term columns of texts: words in the first half, shapes and repeats in the second."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, bytes]] = {}

    def of(self, word: bytes) -> tuple[int, bytes]:
        found = self.known.get(word)
        if found is None:
            shape = word
            for pattern, sign in _SHAPE:
                shape = pattern.sub(sign, shape)
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[word] = zlib.crc32(word.lower()) % _HALF, shape[:16]
        return found

    def counts(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(columns, counts) of one text."""
        words: Counter = Counter()
        pairs: Counter = Counter()
        last = again = b""
        for piece in word_pieces(data):
            found = [self.of(w) for w in piece]
            words.update(c for c, _ in found)
            shapes = [last, *[s for _, s in found]]
            pairs.update(zip(shapes, shapes[1:]))
            same = sum(a == b for a, b in zip(piece, piece[1:])) + (piece[:1] == [again])
            pairs[b"same", b"same"] += same
            last, again = shapes[-1], piece[-1] if piece else again
        lines = [x for x in data.split(b"\n") if x.strip()]
        pairs[b"line", b"again"] = len(lines) - len(set(lines))
        grid: Counter = Counter(words)
        for (a, b), n in pairs.items():
            if n:
                grid[_HALF + zlib.crc32(a + b" " + b) % _HALF] += n
                grid[_HALF + zlib.crc32(b) % _HALF] += n
        return np.fromiter(grid.keys(), np.int64, len(grid)), np.fromiter(grid.values(), np.float64, len(grid))


_TERMS = Terms()


class Space:
    """The fitted space: idf, projection, labelled vectors."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK):
        seen = np.zeros(TERMS)
        for columns, _ in rows:
            seen[columns] += 1
        self.idf = (np.log((1 + len(rows)) / (1 + seen)) + 0.1).astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.labels = labels.astype(np.float32)
        self.projection = np.zeros((TERMS, rank), np.float32)
        if rows:
            half_rank = rank // 2
            for no, half in enumerate((slice(0, _HALF), slice(_HALF, TERMS))):
                directions = _directions([self._weigh(c, n, half) for c, n in rows], half, half_rank)
                self.projection[half, no * half_rank:(no + 1) * half_rank] = directions
        self.vectors = self.project(rows)

    def _weigh(self, columns: np.ndarray, counts: np.ndarray, half: slice) -> tuple[np.ndarray, np.ndarray]:
        """The columns of one half, with tf-idf weights of length 1."""
        inside = (columns >= half.start) & (columns < half.stop)
        own = columns[inside]
        weights = np.log1p(counts[inside]) * self.idf[own]
        length = np.linalg.norm(weights)
        return own, (weights / length if length else weights).astype(np.float32)

    def project(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors of texts; zero without a direction."""
        rank = self.projection.shape[1]
        out = np.zeros((len(rows), rank), np.float32)
        for k, (columns, counts) in enumerate(rows):
            for no, half in enumerate((slice(0, _HALF), slice(_HALF, TERMS))):
                own, weights = self._weigh(columns, counts, half)
                part = slice(no * rank // 2, (no + 1) * rank // 2)
                vector = weights @ self.projection[own, part]
                length = np.linalg.norm(vector)
                out[k, part] = vector / length * (SHAPE_WEIGHT if no else 1 - SHAPE_WEIGHT) if length else 0
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.maximum(length, 1e-9)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Weighted share of label 1 among each text's nearest neighbours."""
        out = np.full(len(rows), self.prior)
        if not len(self.labels):
            return out
        vectors = self.project(rows)
        k = min(NEIGHBOURS, len(self.labels))
        for lo in range(0, len(rows), 256):
            cosines = vectors[lo:lo + 256] @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARP
            total = weights.sum(axis=1)
            votes = (weights * self.labels[near]).sum(axis=1)
            some = total > 1e-12
            out[lo:lo + 256][some] = (votes[some] / total[some]).clip(0, 1)
        return out


def _directions(rows: list[tuple[np.ndarray, np.ndarray]], half: slice, rank: int, rounds: int = 3) -> np.ndarray:
    """The first right singular directions of sparse rows, by subspace iteration."""
    basis = np.random.default_rng(SEED).standard_normal((half.stop - half.start, rank + 16)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(basis)
        ahead = np.zeros_like(basis)
        image = np.empty((len(rows), basis.shape[1]), np.float32)
        for k, (columns, weights) in enumerate(rows):
            image[k] = weights @ basis[columns - half.start]
        for k, (columns, weights) in enumerate(rows):
            ahead[columns - half.start] += weights[:, None] * image[k]
        basis = ahead
    left, _, _ = np.linalg.svd(basis, full_matrices=False)
    return left[:, :rank]


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Space:
    """The space of at most `sample` labelled documents."""
    prepare_python(docs.sparkSession)
    named = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one row for each id, of the smallest text hash: the bound holds for rows too
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")).select(
        "doc_id", "quality", F.col("least.text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_TERMS.counts(x) for x in byte_values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()),
                 pa.array([c.tolist() for c, _ in found], pa.list_(pa.int32())),
                 pa.array([n.tolist() for _, n in found], pa.list_(pa.float32()))], ["doc_id", "quality", "at", "n"])

    got = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, quality int, at array<int>, n array<float>").toPandas().sort_values(
        "doc_id", kind="stable")
    return Space([(np.asarray(a, np.int64), np.asarray(n, np.float64)) for a, n in zip(got["at"], got["n"])],
                 got["quality"].to_numpy(dtype=np.float64))


def scored(docs: DataFrame, space: Space, held_out: Column, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of `docs`; `held_out` is computed from doc_id."""
    spark = docs.sparkSession
    prepare_python(spark)
    sent = spark.sparkContext.broadcast({k: v for k, v in vars(space).items()})
    rows = pick(docs, "doc_id", "text").select("doc_id", held_out.alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Space.__new__(Space)
        vars(own).update(sent.value)
        for batch in batches:
            score = own.score([_TERMS.counts(x) for x in byte_values(batch.column(2))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classifier_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns for `op9_quality_classifier`."""
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    training = pick(labels, "doc_id", "quality").where(~held)
    return scored(docs, fitted(docs, training), held)
