"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A trigram's
vector is the product of its letters' vectors, rotated by their places (binding and permutation); a
text's vector is the sum over its trigrams (bundling), and a language's the sum over its
training texts.  The prediction is the language with the largest cosine.

Learning reads all training rows: each task bundles its rows by language and emits one vector for each, which are
summed by language and component.  The profiles (languages x `DIMENSIONS` numbers) are what is sent to the tasks.

Letters are Unicode letters in lower case; everything else is a word border.  A null text or one
without letters is `und` with score 0, as is every text if nothing could be learned.  Rows without
lang or text teach nothing; a null id counts as a training row.  Of languages with
equal cosines the first by name wins.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import pick, prepare_python, remainder

DIMENSIONS = 1024
SEED = 42
PIECE = 1 << 18

#: Trigram vectors kept by a worker; beyond, the store starts anew.
STORE = 1 << 15


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Codes of all letter trigrams of a text (borders are spaces), piece by piece."""
    known, tail = _letters(), np.array([32], np.uint64)
    for at in range(0, len(text) + 1, PIECE):
        points = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        run = np.concatenate([tail, np.where(known[points], points, 32).astype(np.uint64),
                              np.array([32] if at + PIECE > len(text) else [], np.uint64)])
        keep = run != 32
        keep[0] = True
        keep[1:] |= run[:-1] != 32
        run = run[keep]
        if len(run) > 2:
            yield run[:-2] << np.uint64(42) | run[1:-1] << np.uint64(21) | run[2:]
        tail = run[-2:]


class Store:
    """Trigram vectors by code."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.clear()

    def clear(self) -> None:
        self.places: dict[int, int] = {}
        self.letters: dict[int, np.ndarray] = {}
        self.vectors = np.empty((256, self.dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        vector = self.letters.get(point)
        if vector is None:
            vector = self.letters[point] = np.random.default_rng([self.seed, point]).choice(
                np.array([-1, 1], np.int8), self.dimensions)
        return vector

    def place(self, code: int) -> int:
        at = len(self.places)
        if at == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
        a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        self.vectors[at] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
        self.places[code] = at
        return at

    def bundles(self, texts: list[str]) -> np.ndarray:
        """The vector of each text."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for lo in range(0, len(texts), 128):
            if len(self.places) > STORE:
                self.clear()
            rows, columns, counts = [], [], []
            get = self.places.get
            for k, text in enumerate(texts[lo:lo + 128]):
                for codes in trigrams(text):
                    own, n = np.unique(codes, return_counts=True)
                    columns += [at if (at := get(c)) is not None else self.place(c) for c in own.tolist()]
                    rows.append(np.full(len(own), k))
                    counts.append(n)
            if columns:
                used, inverse = np.unique(np.array(columns), return_inverse=True)
                grid = np.zeros((len(texts[lo:lo + 128]), len(used)), np.float32)
                np.add.at(grid, (np.concatenate(rows), inverse), np.concatenate(counts).astype(np.float32))
                out[lo:lo + 128] = grid @ self.vectors[used].astype(np.float32)
        return out


@lru_cache(maxsize=2)
def _store(dimensions: int, seed: int) -> Store:
    return Store(dimensions, seed)


def profiles(training: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """The vector of each language of `training` (text, lang): one row a language reaches the driver for each component."""
    prepare_python(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            vectors = _store(dimensions, seed).bundles(batch.column(0).to_pylist())
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + vectors[[x == lang for x in langs]].sum(axis=0, dtype=np.float64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "vector": [np.rint(vector).astype(np.int64).tolist()]})

    parts = pick(training, "text", "lang").where("text is not null and lang is not null").mapInArrow(
        run, "lang string, vector array<long>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for lang, at, x in sums.toLocalIterator():
        out.setdefault(lang, np.zeros(dimensions))[at] = x
    return out


def identify(docs: DataFrame, known: dict[str, np.ndarray], held_out: Column, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of `docs`; `held_out` is computed from doc_id."""
    prepare_python(docs.sparkSession)
    names = sorted(known)
    dimensions = len(known[names[0]]) if names else 1
    norms = {n: np.linalg.norm(known[n]) or 1.0 for n in names}
    stack = np.array([known[n] / norms[n] for n in names], np.float32).reshape(len(names), dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(2).to_pylist()]
            preds, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            if names and texts:
                vectors = _store(dimensions, seed).bundles(texts)
                length = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ stack.T) / np.maximum(length, 1e-9)[:, None]
                best = cosines.argmax(axis=1)
                spoken = np.array([any(map(str.isalpha, t)) for t in texts])
                preds[spoken] = np.array(names, object)[best[spoken]]
                scores[spoken] = np.clip(cosines[np.arange(len(texts)), best], 0, 1)[spoken]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(preds.tolist(), pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = pick(docs, "doc_id", "text").select("doc_id", held_out.alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op10_language_id`."""
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    known = profiles(pick(docs, "doc_id", "text", "lang").where(~held))
    return identify(docs, known, held)
