"""Language-model scoring by context-tree weighting over bytes.

Model.  Every byte is eight binary decisions; each has a tree of the preceding bytes, up to
`DEPTH` of them.  A tree node estimates its bit by Krichevsky and Trofimov; from the leaves up,
the weighted probability of a node is half its own estimate and half the product of its children's, and the
prediction mixes the estimates of all depths on the path by the shares that the training data give
them.  Text is scored with the frozen counts; a byte 0xFF ends each text, and 0xFF stands in front.

Every context that occurs in training is a node, however rare.  Counts come from all texts: tasks emit
their distinct strings of DEPTH + 1 bytes (grams), which are summed over the cluster; grams of held-out texts come
along with a count of 0, which leaves every estimate as it is.  A position's score depends on its gram alone, so
`gram_scores` makes a table of the scores of all grams: the gram table is dealt by the TOP + 1 bytes before the
predicted one, a task weighs the trees below such contexts, the driver the tree above them (contexts of up to TOP
bytes: at most 2^16, whatever the corpus), and the tasks mix from there down to the leaves.
Grams in at least 1 of `FREQUENT_GRAMS` positions (so at most that many) are sent to the tasks; all other
positions are joined to the table, so none is left out.

Base score.  Unigram word probabilities with add-one smoothing over the training words.  Words in at
least 1 of `FREQUENT` training tokens (so at most that many) and up to 64 bytes long are sent to the tasks;
all others are joined by word, which also keeps hot words out of that join.

Null texts are empty (one end token).  A null id counts as a training row.  Repeated rows
count as often as they occur and are scored each.  Without training rows the model is uniform.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import byte_values, checkpointed, pick, prepare_python, remainder, word_pieces, written

DEPTH = 5
TOP = 2
FREQUENT = 1 << 18
FREQUENT_GRAMS = 1 << 22
LONGEST_SENT = 64
WINDOW = 1 << 20
FLUSH = 1 << 21
CHUNK = 1 << 16
END = b"\xff"


def stream(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, each behind `depth` end bytes and closed by one, and the places of their starts."""
    joined = np.frombuffer(b"".join([END * depth + t + END for t in texts]), np.uint8)
    return joined, np.cumsum([0, *[len(t) + depth + 1 for t in texts]])


def _predicted(starts: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Which places of the stream are predicted: all but those in front of a text."""
    mask = np.ones(size, bool)
    for k in range(depth):
        mask[starts[:-1] + k] = False
    return mask


def grams(texts: list[bytes], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct strings of depth + 1 bytes (as numbers, the last byte lowest) and their counts, window by window."""
    data, starts = stream(texts, depth)
    mask = _predicted(starts, len(data), depth)
    for lo in range(depth, len(data), WINDOW):
        part = data[lo - depth:lo + WINDOW].astype(np.int64)
        n = len(part) - depth
        key = np.zeros(n, np.int64)
        for k in range(depth + 1):
            key = key << 8 | part[k:k + n]
        yield np.unique(key[mask[lo:lo + n]], return_counts=True)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of each of their counts."""
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *[np.bincount(inverse, np.concatenate(c), len(keys)).astype(np.int64) for c in list(zip(*parts))[1:]]


def gram_counts(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n, m) over texts of `rows` (held_out, text): n in those not held out, m in all; one row a gram and stretch of a task."""
    prepare_python(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> Iterator[pa.RecordBatch]:
            found = _merged(held)
            held.clear()
            for at in range(0, len(found[0]), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 17)]) for x in found], ["gram", "n", "m"])

        for batch in batches:
            texts, kinds = [x.lower() for x in byte_values(batch.column(1))], batch.column(0).to_pylist()
            for kind in (False, True):
                some = [t for t, k in zip(texts, kinds) if k == kind]
                if some:
                    held += [(k, np.zeros_like(n) if kind else n, n) for k, n in grams(some, depth)]
            if sum(len(p[0]) for p in held) > FLUSH:
                held[:] = [_merged(held)]
                if len(held[0][0]) > FLUSH // 2:
                    yield from out()
        if held:
            yield from out()

    return rows.select("held_out", "text").mapInArrow(run, "gram long, n long, m long")


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) over all tokens of `training`; the end token is the empty word."""
    prepare_python(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            words, counts = list(held), list(held.values())
            held.clear()
            for at in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + (1 << 16)], pa.binary()),
                                                  pa.array(counts[at:at + (1 << 16)], pa.int64())], ["word", "c"])

        for batch in batches:
            for data in byte_values(batch.column(0)):
                held[b""] += 1
                for words in word_pieces(data.lower()):
                    held.update(words)
            if len(held) > FLUSH // 4:
                yield from rows()
        if held:
            yield from rows()

    return pick(training, "text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2: shifted by 6, then Stirling's series."""
    shift = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (
        1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)) - np.log(shift)


def _nodes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of bits 0 and 1 in each of a byte's 255 binary decisions (heap order), from counts of bytes."""
    levels = [counts]
    while levels[0].shape[1] > 1:
        levels.insert(0, levels[0].reshape(len(counts), levels[0].shape[1] // 2, 2).sum(axis=2))
    return (np.concatenate([level[:, 0::2] for level in levels[1:]], axis=1),
            np.concatenate([level[:, 1::2] for level in levels[1:]], axis=1))


def _estimate(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Krichevsky-Trofimov: log probability of the counts, and the probability that the next bit is 1."""
    return _kt(*_nodes(counts))


def _kt(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the counts of bits 0 and 1."""
    total = zeros + ones
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(total + 1) - np.log(np.pi), (ones + 0.5) / (total + 1)


def _byte_scores(one: np.ndarray) -> np.ndarray:
    """log10 probability of every byte, from the probabilities of bit 1 at its decisions."""
    scores = np.zeros((len(one), 1))
    at = 0
    while scores.shape[1] < 256:
        n = scores.shape[1]
        p = one[:, at:at + n]
        scores = np.stack([scores + np.log10(1 - p), scores + np.log10(p)], axis=2).reshape(len(one), 2 * n)
        at += n
    return scores


class Model:
    """The model in memory, for few contexts (tests hold `gram_scores` against it).

    The automaton (`follow`: state and byte to state) and the scores of each byte in each state.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        """`levels`: for each depth from 0 the sorted contexts (numbers) and their counts of next bytes."""
        self.depth = len(levels) - 1
        keys = [k for k, _ in levels]
        counts = [c.astype(np.float64) for _, c in levels]
        first = np.cumsum([0, *[len(k) for k in keys]])
        up = [np.zeros(0, np.int64)] + [
            np.searchsorted(keys[d - 1], keys[d] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, len(keys))]
        # from the leaves: weighted log probabilities, and each node's share in its own mixture
        share: list[np.ndarray] = [np.ones(0)] * len(keys)
        rest: list[np.ndarray] = [np.ones(0)] * len(keys)
        below = None
        for d in range(self.depth, -1, -1):
            log_own, _ = _estimate(counts[d])
            if d == self.depth:
                below = log_own
                continue
            rest[d] = counts[d].copy()
            product = np.zeros_like(log_own)
            np.subtract.at(rest[d], up[d + 1], counts[d + 1])
            np.add.at(product, up[d + 1], below)
            others = _estimate(rest[d])[0] + product
            weighted = np.logaddexp(log_own, others)  # the halves cancel in the share
            share[d] = np.exp(log_own - weighted)
            below = weighted - np.log(2)
        # from the root: the mixture so far and what is left for the deeper nodes
        self.scores = np.empty((first[-1], 256), np.float32)
        self.follow = np.zeros((first[-1], 256), np.int32)
        mixed, left = np.zeros((1, 255)), np.ones((1, 255))
        for d in range(len(keys)):
            _, own = _estimate(counts[d])
            if d:
                mixed, left = mixed[up[d]], left[up[d]]
            if d == self.depth:
                one = mixed + left * own
            else:
                mixed, left = mixed + left * share[d] * own, left * (1 - share[d])
                one = mixed + left * _estimate(rest[d])[1]
            self.scores[first[d]:first[d + 1]] = _byte_scores(one)
        for d in range(len(keys)):
            follow = self.follow[first[d]:first[d + 1]]
            if d:
                follow[:] = self.follow[first[d - 1] + up[d]]
            if d < self.depth and len(keys[d + 1]):
                before = np.searchsorted(keys[d], keys[d + 1] >> 8)
                known = keys[d][np.minimum(before, len(keys[d]) - 1)] == keys[d + 1] >> 8
                follow[before[known], keys[d + 1][known] & 255] = first[d + 1] + np.flatnonzero(known)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included."""
        data, starts = stream(texts, self.depth)
        follow, scores = self.follow.ravel(), self.scores.ravel()
        mask = _predicted(starts, len(data), self.depth)
        out = np.zeros(len(texts))
        for lo in range(self.depth, len(data), WINDOW):
            part = data[lo - self.depth:lo + WINDOW].astype(np.int32)
            n = len(part) - self.depth
            state = np.zeros(n, np.int32)
            for k in range(self.depth):
                state = follow[(state << 8) | part[k:k + n]]
            here = np.where(mask[lo:lo + n], scores[(state << 8) | part[self.depth:]], 0).astype(np.float64)
            a, b = np.searchsorted(starts, [lo, lo + n - 1], side="right") - 1
            edges = np.maximum(starts[a:b + 1], lo) - lo
            out[a:b + 1] += np.add.reduceat(here, edges)
        return out


class Tree:
    """Nodes (context and place among a byte's 255 decisions) at depths `low` to `high`, sparse.

    Keys are context << 8 | place, so that the key of the context without its oldest byte is a part of it.
    """

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, low: int, high: int,
                 below: np.ndarray | None = None):
        """`keys`: those of depth `high`, sorted; `below`: sums of their children's log probabilities, unless leaves."""
        self.low, self.leaves = low, below is None
        self.keys, self.own, self.share, self.up = [], [], [], []
        for d in range(high, low - 1, -1):
            log_own, own = _kt(zeros, ones)
            weighted = log_own if below is None else np.logaddexp(log_own, below)
            self.keys.insert(0, keys)
            self.own.insert(0, own)
            self.share.insert(0, np.exp(log_own - weighted))
            #: of the shallowest nodes: weighted log probability, counts, and keys of the nodes above them
            self.weighted = weighted if below is None else weighted - np.log(2)
            self.zeros, self.ones = zeros, ones
            self.above = keys & ((1 << 8 * d) - 1) if d else np.zeros(len(keys), np.int64)
            if d > low:
                keys, up = np.unique(self.above, return_inverse=True)
                self.up.insert(0, up)
                zeros, ones, below = (np.bincount(up, x, len(keys)) for x in (zeros, ones, self.weighted))

    def mix(self, mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixture so far and what is left for deeper nodes, at depth `high`; given: the same above depth `low`."""
        for k, (own, share) in enumerate(zip(self.own, self.share)):
            if k:
                mixed, left = mixed[self.up[k - 1]], left[self.up[k - 1]]
            mixed, left = mixed + left * share * own, left * (1 - share)
        return mixed, left


def _leaves(gram: np.ndarray, n: np.ndarray, low: int, depth: int) -> tuple[Tree, np.ndarray, np.ndarray]:
    """The trees of `gram` from depth `low` down, the leaf of each gram's eight decisions, and their bits."""
    byte, level = (gram & 255)[:, None], np.arange(8)
    place, bit = (1 << level) | byte >> (8 - level), byte >> (7 - level) & 1
    keys, leaf = np.unique((gram >> 8 << 8)[:, None] | place, return_inverse=True)
    zeros, ones = (np.bincount(leaf.ravel(), (n[:, None] * b).ravel(), len(keys)) for b in (1 - bit, bit))
    return Tree(keys, zeros, ones, low, depth), leaf.reshape(bit.shape), bit


def _chunks(batches: Iterator[pa.RecordBatch], low: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of all batches (the first: grams, sorted by their last `low` bytes of context), cut between such contexts."""
    mask, held, size, last = (1 << 8 * low) - 1, [], 0, None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        context = columns[0] >> 8 & mask
        if not len(context):
            continue
        change = np.flatnonzero(context[1:] != context[:-1])
        # where the batch's last context begins, counted over all held rows; 0: it began with them
        cut = size + int(change[-1]) + 1 if len(change) else size if context[0] != last else 0
        held.append(columns)
        size, last = size + len(context), context[-1]
        if size >= CHUNK and cut:
            whole = [np.concatenate(x) for x in zip(*held)]
            yield tuple(x[:cut] for x in whole)
            held, size = [[x[cut:] for x in whole]], size - cut
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def gram_scores(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, m, score): the log10 probability of each gram's last byte after the others; `counted` has gram, n, m,
    where a gram may have several rows.

    One exchange serves the sums and the trees: both are dealt by the contexts' last bytes.
    """
    spark = counted.sparkSession
    top = min(TOP, depth - 1)  # the driver's depth; depth is 1 at least
    low = top + 1
    context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * low) - 1))
    dealt = checkpointed(counted.select("gram", "n", "m", context.alias("near")).repartition("near").groupBy("near", "gram").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m")).sortWithinPartitions("near").select("gram", "n", "m"))

    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, _ in _chunks(batches, low):
            tree = _leaves(gram, n, low, depth)[0]
            keys, up = np.unique(tree.above, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(np.bincount(up, x, len(keys))) for x in (
                tree.zeros, tree.ones, tree.weighted)]], ["key", "zeros", "ones", "below"])

    # at most 2^16 contexts of 255 decisions each
    got = dealt.mapInArrow(rise, "key long, zeros double, ones double, below double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toPandas().sort_values("key")
    keys = got["key"].to_numpy(np.int64)
    tree = Tree(keys, *[got[c].to_numpy(np.float64) for c in ("zeros", "ones")], 0, top, got["below"].to_numpy(np.float64))
    first = len(tree.keys[0])
    sent = spark.sparkContext.broadcast((keys, *tree.mix(np.zeros(first), np.ones(first))))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mixed, left = sent.value
        for gram, n, m in _chunks(batches, low):
            tree, leaf, bit = _leaves(gram, n, low, depth)
            at = np.searchsorted(known, tree.above)
            one = tree.mix(mixed[at], left[at])[0]  # a leaf's share is 1: nothing is left
            p = one[leaf]
            score = np.log10(np.where(bit == 1, p, 1 - p)).sum(axis=1)
            for k in range(0, len(gram), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[k:k + (1 << 17)]) for x in (gram, m, score)], ["gram", "m", "score"])

    return written(dealt.mapInArrow(descend, "gram long, m long, score double"))


class Lookup:
    """Scores of the grams sent to the tasks; a chain of hash tables, each with what found no place in those before."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        factor = 0x9E3779B97F4A7C15
        while len(keys):
            shift = 64 - max(4, int(len(keys)).bit_length())
            held, value = np.full(1 << (64 - shift), -1, np.int64), np.zeros(1 << (64 - shift))
            slot = self._slots(keys, factor, shift)
            held[slot] = keys
            here = held[slot] == keys
            value[slot[here]] = scores[here]
            self.tables.append((factor, shift, held, value))
            keys, scores = keys[~here], scores[~here]
            factor = (factor * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1

    @staticmethod
    def _slots(keys: np.ndarray, factor: int, shift: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(shift)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of `keys`, 0 where there is none, and the places of those."""
        out, todo = np.zeros(len(keys)), np.arange(len(keys))
        for factor, shift, held, value in self.tables:
            some = keys[todo]
            slot = self._slots(some, factor, shift)
            here = held[slot] == some
            out[todo[here]] = value[slot[here]]
            todo = todo[~here]
        return out, todo

    def score(self, texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each text, the grams that are not held left out; those grams and how many up to each text's end."""
        data, starts = stream(texts, depth)
        mask = _predicted(starts, len(data), depth)
        total, rare, places = np.zeros(len(texts)), [], []
        for lo in range(depth, len(data), WINDOW):
            part = data[lo - depth:lo + WINDOW].astype(np.int64)
            n = len(part) - depth
            key = np.zeros(n, np.int64)
            for k in range(depth + 1):
                key = key << 8 | part[k:k + n]
            at = np.flatnonzero(mask[lo:lo + n])
            found, missed = self.find(key[at])
            text = np.searchsorted(starts, lo + at, side="right") - 1
            total += np.bincount(text, found, len(texts))
            rare.append(key[at[missed]])
            places.append(text[missed])
        ends = np.bincount(np.concatenate(places), minlength=len(texts)) if places else np.zeros(len(texts), np.int64)
        return total, np.concatenate(rare) if rare else np.zeros(0, np.int64), np.cumsum([0, *ends])


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows that are not `held_out` (a column computed from doc_id).
    """
    spark = docs.sparkSession
    prepare_python(spark)
    rows = pick(docs, "doc_id", "text").select("doc_id", held_out.alias("held_out"), "text")
    training = rows.where(~F.col("held_out"))
    table = gram_scores(gram_counts(rows))
    places = table.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    most = table.where(F.col("m") >= max(1, -(-places // FREQUENT_GRAMS))).select("gram", "score").toPandas()
    held = spark.sparkContext.broadcast(Lookup(most["gram"].to_numpy(np.int64), most["score"].to_numpy(np.float64)))
    words = written(word_counts(training))
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    often = words.where((F.col("c") >= max(1, -(-tokens // FREQUENT))) & (F.length("word") <= LONGEST_SENT)).toPandas()
    sent = spark.sparkContext.broadcast({bytes(w): int(c) for w, c in zip(often["word"], often["c"])})
    under = float(np.log10(tokens + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        log = {w: float(np.log10(c + 1)) for w, c in known.items()}
        for batch in batches:
            texts = [x.lower() for x in byte_values(batch.column(2))]
            n_tokens, n_known, base, rare = [], [], [], []
            for data in texts:
                found: Counter = Counter({b"": 1})
                for piece in word_pieces(data):
                    found.update(piece)
                n_tokens.append(found.total())
                n_known.append(sum(n for w, n in found.items() if w in known))
                base.append(sum(n * log[w] for w, n in found.items() if w in log))
                rare.append([{"word": w, "n": n} for w, n in found.items() if w not in known])
            score, grams_left, ends = held.value.score(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score),
                 pa.array([len(t) + 1 for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams_left, pa.int64())),
                 pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                ["doc_id", "held_out", "n_tokens", "n_often", "base", "part", "n_bytes", "grams", "rare"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = written(rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_often long, base double, part double, "
             "n_bytes long, grams array<long>, rare array<struct<word: binary, n: long>>").withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(words, "word").groupBy(
        "row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"), F.sum("n").alias("n_rare"))
    deep = scored.select("row", F.explode("grams").alias("gram")).join(table.select("gram", F.col("score").alias("s")), "gram").groupBy(
        "row").agg(F.sum("s").alias("deeper"))
    whole = scored.join(rare, "row", "left").join(deep, "row", "left").withColumn(
        "score", F.col("part") + F.coalesce("deeper", F.lit(0.0)))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_often") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * under).alias("base_score"),
        "score", (-F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"))


def scoring_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op5_lm_scoring`."""
    return score_texts(docs, F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False)))
