"""Quality rules: boosted trees over document statistics.

`statistics` counts what the base rules and the trees look at.  The trees are fitted to the
labels of at most `SAMPLE` documents (those with the smallest hash of their id: a documented bound
for fitting only): gradient boosting of the logistic loss over quantile
bins, in numpy.  Features in `FALLING` may only lower the score as they grow: a split that would raise it
is not taken, and the values below a split are bounded by the mean of its sides.  The fitted trees
are flattened into node arrays of one shape, and a batch of documents walks all trees level by level.

Null and empty texts have no words and fail the base rules.  Without labels the trees say yes to
all.  Equal rows get equal results; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import byte_values, pick, positional, prepare_python, word_pieces

SAMPLE = 20_000
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
LEAST = 20
RIDGE = 2.0

#: A document passes the trees from this probability of good quality on: only clear cases go.
THRESHOLD = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbols", "dup_lines", "repeat_words", "upper", "digits", "marks", "marked_ends",
            "distinct", "bare", "line_words", "wide")
FALLING = ("symbols", "dup_lines", "repeat_words", "upper", "marks", "marked_ends", "bare")

_SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _size(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def statistics(data: bytes) -> tuple[tuple[int, ...], list[float]]:
    """COUNTS and FEATURES of one text."""
    seen: dict[bytes, int] = {}
    number = seen.setdefault
    parts, ends, bare = [], 0, 0
    for words in word_pieces(data):
        parts.append(np.array([number(w, len(seen)) for w in words], np.int64))
        ends += sum(w[-1] in b"#*$%&|<>!" for w in words)
        bare += words.count(b"|")
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    n, repeat = len(ids), 0
    if n > 3:
        distinct = len(seen)
        pairs = ids[:-2] * distinct + ids[1:-1]
        if distinct > 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, inverse, times = np.unique(pairs * distinct + ids[2:], return_inverse=True, return_counts=True)
        again = times[inverse] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= again
        repeat = int(covered.sum())
    lines, dup, filled = set(), 0, 0
    for line in data.split(b"\n"):
        if line.strip():
            filled += 1
            if line in lines:
                dup += 1
            else:
                lines.add(line)
    chars = len(data) - _size(data, bytes(range(0x80, 0xC0)))
    inside = chars - _size(data, _SPACES)
    symbols = _size(data, b"#*$%&|<>")
    per = 1 / max(inside, 1)
    features = [np.log1p(n), inside / max(n, 1), symbols * per, dup / max(filled, 1), repeat / max(n, 1),
                _size(data, _UPPER) * per, _size(data, _DIGITS) * per, _size(data, _MARKS) * per, ends / max(n, 1),
                len(seen) / max(n, 1), bare / max(n, 1), n / max(filled, 1), (len(data) - chars) * per]
    return (n, inside, symbols, dup, repeat), features


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node k has children 2k+1 and 2k+2; `left` where the feature is at most `cut`."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of `x`."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            while 2 * node.max(initial=0) + 2 < len(value):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, falling: tuple[bool, ...], trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the labels `y` (0 or 1); without both labels all rows get the share of 1 (1 without rows)."""
    inner, size = 2 ** depth - 1, 2 ** (depth + 1) - 1
    features, cuts, values = [], [], []
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1 - 1e-3
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Trees(np.empty((0, inner), int), np.empty((0, inner)), np.empty((0, size)), start)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    total = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, cut, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(size)
        low, high = np.full(size, -np.inf), np.full(size, np.inf)
        node = np.zeros(len(y), np.int64)

        def worth(g, h):
            return g / (h + RIDGE)

        for k in range(size):
            here = node == k
            g, h = grad[here], hess[here]
            value[k] = np.clip(worth(g.sum(), h.sum()), low[k], high[k])
            if k >= inner:
                continue
            best = 1e-6
            for f in range(x.shape[1]):
                bins = binned[here, f]
                gs, hs, ns = (np.bincount(bins, w, BINS).cumsum()[:-1] for w in (g, h, np.ones(len(g))))
                gr, hr = g.sum() - gs, h.sum() - hs
                left, right = (np.clip(worth(a, b), low[k], high[k]) for a, b in ((gs, hs), (gr, hr)))
                gain = gs * left - (hs + RIDGE) * left ** 2 / 2 + gr * right - (hr + RIDGE) * right ** 2 / 2 - (
                    g.sum() * value[k] - (h.sum() + RIDGE) * value[k] ** 2 / 2)
                gain[(ns < LEAST) | (len(g) - ns < LEAST)] = 0
                if falling[f]:
                    gain[right > left] = 0
                at = int(gain[:len(edges[f])].argmax()) if len(edges[f]) else 0
                if len(edges[f]) and gain[at] > best:
                    best, feature[k], cut[k] = gain[at], f, edges[f][at]
                    middle = (left[at] + right[at]) / 2
                    bounds = (middle, high[k], low[k], middle) if falling[f] else (low[k], high[k], low[k], high[k])
            if cut[k] < np.inf:
                low[2 * k + 1], high[2 * k + 1], low[2 * k + 2], high[2 * k + 2] = bounds
            else:  # all rows go on to the left with this node's value
                low[2 * k + 1] = high[2 * k + 1] = value[k]
            node[here] = 2 * k + 1 + (x[here, feature[k]] > cut[k])
        total += RATE * value[node]
        features.append(feature)
        cuts.append(cut)
        values.append(RATE * value)
    return Trees(np.array(features), np.array(cuts), np.array(values), start)


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for `labels.quality`, from at most `sample` labelled documents."""
    prepare_python(docs.sparkSession)
    named = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one row for each id, of the smallest text hash: the bound holds for rows too
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")).select(
        "quality", F.col("least.text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(
                [statistics(x)[1] for x in byte_values(batch.column(1))], pa.list_(pa.float64()))], ["quality", "x"])

    got = rows.mapInArrow(run, "quality int, x array<double>").toArrow()
    y = got["quality"].to_numpy().astype(float)
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES))
    order = np.lexsort([*x.T[::-1], y])  # the same trees whatever order the rows came in
    return fit(x[order], y[order], tuple(f in FALLING for f in FEATURES))


def judged(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and quality (the trees' probability) of every row."""
    prepare_python(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept, quality = verdicts(byte_values(batch.column(1)), trees, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in counts.T], pa.array(failed), pa.array(kept), pa.array(quality)],
                ["doc_id", *COUNTS, "base_failed", "kept", "quality"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + "".join(f"{c} long, " for c in COUNTS)
                           + "base_failed boolean, kept boolean, quality double")


def verdicts(texts: list[bytes], trees: Trees, threshold: float) -> tuple[np.ndarray, ...]:
    """Counts, base_failed, kept and probability of each text."""
    found = [statistics(t) for t in texts]
    counts = np.array([c for c, _ in found], np.int64).reshape(len(texts), len(COUNTS))
    quality = trees.score(np.array([f for _, f in found]).reshape(len(texts), len(FEATURES)))
    failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
    return counts, failed, ~failed & (quality >= threshold), quality


def keep_good(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are kept, as they are."""
    prepare_python(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(verdicts(byte_values(batch.column(at)), trees, threshold)[2]))

    rows = positional(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns for `op8_quality_rules`."""
    return judged(docs, fitted(docs, labels))
