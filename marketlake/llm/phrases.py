"""Phrase collocations from weighted acyclic automata.

A phrase is a run of words inside one piece of a text.  Each word starts one n-gram: itself and up to three more
words of its piece.  How often a phrase of up to four words occurs is how many of these n-grams begin with it, so it is the
weight of a prefix.

Shards.  A task collects the n-grams of bounded shards of its texts, sorts them and builds from them a count transducer
(`Transducer`): an acyclic automaton whose paths are the distinct n-grams and whose last arcs carry their counts.  It
is built level by level from the deepest states up, and states with equal arcs (label, target, weight) are one state, as
incremental construction from sorted input gives.  A shard's n-grams are cut at the borders of prefix ranges, with one transducer for
each range and language, so what crosses the network are automata, not n-grams.

Union.  Each range's transducers are joined: their paths merged in order, the counts of equal ones summed; every prefix gets the
sum of the range of paths below it.  Prefixes that occur too seldom are pruned; those that a range's border cuts
are kept whatever their count, and their parts are summed over ranges (at most eight a border).

Composition.  Candidates are walked off the pruned automata, which gives the counts of their first parts on the way.
The counts of their rests are looked up by composing: the rests that fall into a range form an acceptor, and both automata are
walked together, level by level (`PrefixCounts.compose`).  The lookups of one range are salted over several tasks, each of which
gets the range's pruned automaton.

Borders only balance the work: they are drawn from n-grams of a sample of documents and lie between whole n-grams, so a hot first
word is spread over many ranges.  All counts, products and limits are exact; every phrase of every text is counted.

Null texts are empty; a null lang is `und`.  Repeated rows count as often as they occur.  Ties are ranked by count, then by the
phrase's bytes.  An empty table gives an empty result; further columns are not read.  Very long texts are cut into shards too.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import pick, prepare_python
from marketlake.llm.units import gathered, spans, text_buffers
from marketlake.session import checkpoint_dir

#: Words of the longest phrase.
LONGEST = 4

#: Phrases that occur less often are no candidates; how many are ranked; a longer phrase absorbs a part that occurs
#: more often by at most a quarter.
LEAST, TOP = 30, 2000

#: Words of a shard, and n-grams that a range should have.
SHARD_WORDS = 3 << 19
RANGE_WORDS = 1 << 20

#: Documents and n-grams a document from which borders are drawn.
SAMPLE_DOCS, SAMPLE_GRAMS = 4000, 32

#: Tasks over which the lookups of one range are dealt.
SALT = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_CLASS[[9, 32]] = 1
_CLASS[[10, 11, 12, 13, *b".,;:!?"]] = 2

Gram = tuple[bytes, ...]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(lower-cased words, piece of each, text of each) of texts that stand one behind another."""
    kind = _CLASS[data]
    starts = np.zeros(len(data) + 1, bool)
    starts[offsets] = True
    own = kind == 0
    first = own.copy()
    first[1:] &= ~own[:-1] | starts[1:-1]
    at = np.flatnonzero(first)
    border = np.cumsum((kind == 2) | starts[:-1])
    through = np.concatenate([[0], np.cumsum(own)])
    ends = np.append(through[at], through[-1])
    array = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[data[own]])])
    return array.dictionary_encode(), border[at], np.searchsorted(offsets, at, "right") - 1


def grams(numbers: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Rows of up to `LONGEST` words, one for each word; -1 behind the piece's end."""
    out = np.full((len(numbers), LONGEST), -1, np.int64)
    for k in range(min(LONGEST, len(numbers))):
        out[:len(numbers) - k, k] = np.where(piece[k:] == piece[:len(numbers) - k], numbers[k:], -1)
    return out


def ordered(rows: np.ndarray) -> np.ndarray:
    """The order of n-grams by their words' numbers."""
    most = int(rows.max(initial=0)) + 2
    if most ** 3 < 1 << 63:
        return np.lexsort((rows[:, 3], ((rows[:, 0] + 1) * most + rows[:, 1] + 1) * most + rows[:, 2] + 1))
    return np.lexsort(rows.T[::-1])


def summed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, with the sums of their weights."""
    order = ordered(rows)
    rows, weights = rows[order], weights[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return rows[at], np.add.reduceat(weights, at) if len(at) else weights


class Transducer:
    """A minimal acyclic automaton over sorted n-grams of `LONGEST` labels (-1: the n-gram is over).

    `labels[d]` and `targets[d]` are the arcs of depth d, state by state; state s of depth d has the arcs from
    `starts[d][s]` on.  A target is a state of the next depth, and behind the last arc the n-gram's weight.
    """

    def __init__(self, vocabulary: list[bytes], starts: list[np.ndarray], labels: list[np.ndarray], targets: list[np.ndarray]):
        self.vocabulary, self.starts, self.labels, self.targets = vocabulary, starts, labels, targets

    @classmethod
    def build(cls, rows: np.ndarray, weights: np.ndarray, vocabulary: list[bytes]) -> Transducer:
        """From distinct n-grams in order; only the words in use are kept."""
        used = np.unique(rows)
        used = used[used >= 0]
        rows = np.where(rows < 0, -1, np.searchsorted(used, rows))
        new = np.ones((LONGEST, len(rows)), bool)  # where a path of depth d + 1 differs from the one before
        for d in range(LONGEST):
            new[d, 1:] = rows[1:, d] != rows[:-1, d]
            if d:
                new[d] |= new[d - 1]
        starts, labels, targets = [], [], []
        below = weights
        for d in reversed(range(LONGEST)):
            arcs = np.flatnonzero(new[d])
            label = rows[arcs, d]
            owner = np.cumsum(new[d - 1])[arcs] - 1 if d else np.zeros(len(arcs), np.int64)
            start = np.searchsorted(owner, np.arange((owner[-1] + 1 if len(owner) else 0) + 1))
            kept, state = _register(start, label, below)
            size = np.diff(start)[kept]
            taken = spans(start[:-1][kept], size)
            starts.insert(0, np.concatenate([[0], np.cumsum(size)]))
            labels.insert(0, label[taken])
            targets.insert(0, below[taken])
            below = state
        return cls([vocabulary[i] for i in used.tolist()], starts, labels, targets)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams, weights) in order."""
        at, columns = np.zeros(1 if len(self.starts[0]) > 1 else 0, np.int64), []
        for d in range(LONGEST):
            size = np.diff(self.starts[d])[at]
            arcs = spans(self.starts[d][:-1][at], size)
            columns = [np.repeat(c, size) for c in columns] + [self.labels[d][arcs]]
            at = self.targets[d][arcs]
        return np.stack(columns, axis=1), at

    def to_bytes(self) -> bytes:
        parts = [_pack(np.fromiter(map(len, self.vocabulary), np.int64, len(self.vocabulary))), b"".join(self.vocabulary)]
        for d in range(LONGEST):
            parts += [_pack(np.diff(self.starts[d])), _pack(self.labels[d] + 1), _pack(self.targets[d])]
        heads = np.array([len(p) for p in parts], "<i8").tobytes()
        body = heads + b"".join(parts)
        return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Transducer:
        body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
        count = 2 + 3 * LONGEST
        ends = 8 * count + np.cumsum(np.frombuffer(body[:8 * count], "<i8"))
        parts = [body[a:b] for a, b in zip([8 * count, *ends.tolist()], ends.tolist())]
        cut = np.concatenate([[0], np.cumsum(_unpack(parts[0]))]).tolist()
        vocabulary = [parts[1][a:b] for a, b in zip(cut, cut[1:])]
        starts = [np.concatenate([[0], np.cumsum(_unpack(p))]) for p in parts[2::3]]
        return cls(vocabulary, starts, [_unpack(p) - 1 for p in parts[3::3]], [_unpack(p) for p in parts[4::3]])


def _register(start: np.ndarray, label: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first state of each distinct list of arcs, which of them each state is)."""
    size = np.diff(start)
    state, kept = np.empty(len(size), np.int64), []
    one = np.flatnonzero(size == 1)
    if len(one):  # most states have one arc
        order = np.lexsort((target[start[one]], label[start[one]]))
        a, b = label[start[one]][order], target[start[one]][order]
        new = np.ones(len(one), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        state[one[order]] = np.cumsum(new) - 1
        kept = one[order[new]].tolist()
    known: dict[bytes, int] = {}
    arcs = np.stack([label, target], axis=1)
    more = np.flatnonzero(size > 1)
    for s, a, b in zip(more.tolist(), start[more].tolist(), start[more + 1].tolist()):
        number = known.setdefault(arcs[a:b].tobytes(), len(kept))
        if number == len(kept):
            kept.append(s)
        state[s] = number
    return np.array(kept, np.int64), state


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes of one size."""
    size = next(s for s in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * s)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpack(part: bytes) -> np.ndarray:
    return np.frombuffer(part, f"<u{part[0]}", offset=1).astype(np.int64)


def union(parts: list[Transducer]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(vocabulary in order, n-grams in order, summed weights) of several transducers."""
    vocabulary = sorted(set().union(*[t.vocabulary for t in parts]))
    number = {w: i for i, w in enumerate(vocabulary)}
    rows, weights = [], []
    for t in parts:
        own = np.array([number[w] for w in t.vocabulary] + [-1], np.int64)
        path, weight = t.paths()
        rows.append(own[path])
        weights.append(weight)
    return vocabulary, *summed(np.concatenate(rows), np.concatenate(weights))


class PrefixCounts:
    """The pruned automaton of a range: a state for each kept prefix, with its count, in order of depth and path.

    `levels[d]` is (parent state, word, count) of the prefixes of d + 1 words.
    """

    def __init__(self, vocabulary: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.vocabulary, self.levels = vocabulary, levels
        self.numbers = {w: i for i, w in enumerate(vocabulary)}

    @classmethod
    def prune(cls, vocabulary: list[bytes], rows: np.ndarray, weights: np.ndarray, least: int, borders: list[Gram]) -> PrefixCounts:
        """Prefixes of the n-grams that occur `least` times, or that a border may cut."""
        new, levels = np.zeros(len(rows), bool), []
        parent_of = np.zeros(len(rows), np.int64)  # state of each path's prefix so far; -1: pruned
        words_of = np.array(vocabulary, object)
        through = np.concatenate([[0], np.cumsum(weights)])
        new[:1] = True
        for d in range(LONGEST):
            new[1:] |= rows[1:, d] != rows[:-1, d]
            at = np.flatnonzero(new)
            count = through[np.append(at[1:], len(rows))] - through[at]
            keep = (rows[at, d] >= 0) & (parent_of[at] >= 0)
            keep &= (count >= least) | _cut_by(rows[at, :d + 1], words_of, borders)
            number = np.where(keep, np.cumsum(keep) - 1, -1)
            levels.append((parent_of[at][keep], rows[at, d][keep], count[keep]))
            parent_of = number[np.cumsum(new) - 1] if len(rows) else parent_of
        return cls(vocabulary, levels)

    def phrases(self) -> list[list[tuple[Gram, int, int]]]:
        """By depth: (phrase, count, state of the parent)."""
        out: list[list[tuple[Gram, int, int]]] = []
        for parent, word, count in self.levels:
            before = [p[0] for p in out[-1]] if out else [()]
            out.append([((*before[p], self.vocabulary[w]), n, p) for p, w, n in zip(parent.tolist(), word.tolist(), count.tolist())])
        return out

    def compose(self, queries: list[Gram]) -> np.ndarray:
        """The count of each query (0 where it is no kept prefix), walked together with the acceptor of the queries."""
        out, order = np.zeros(len(queries), np.int64), sorted(range(len(queries)), key=queries.__getitem__)
        state = np.zeros(len(queries), np.int64)
        label = np.full((len(queries), LONGEST), -1, np.int64)
        for i, q in enumerate(order):
            label[i, :len(queries[q])] = [self.numbers.get(w, -2) for w in queries[q]]
        alive = np.ones(len(queries), bool)
        for d, (parent, word, count) in enumerate(self.levels):
            wide = len(self.vocabulary) + 1
            here = alive & (label[:, d] >= 0)
            key = np.flatnonzero(here)
            pair = state[key] * wide + label[key, d]
            arcs = parent * wide + word
            place = np.minimum(np.searchsorted(arcs, pair), max(len(arcs) - 1, 0))
            hit = arcs[place] == pair if len(arcs) else np.zeros(len(pair), bool)
            alive = np.zeros(len(queries), bool)
            alive[key[hit]] = True
            state[key[hit]] = place[hit]
            last = key[hit][label[key[hit], d + 1] == -1] if d + 1 < LONGEST else key[hit]
            out[np.array(order, np.int64)[last]] = count[state[last]]
        return out


def _cut_by(prefixes: np.ndarray, words_of: np.ndarray, borders: list[Gram]) -> np.ndarray:
    """Which prefixes also begin a border (only those can go on beyond it)."""
    out = np.zeros(len(prefixes), bool)
    depth = prefixes.shape[1]
    for border in borders:
        if len(border) < depth:
            continue
        same = np.ones(len(prefixes), bool)
        for d in range(depth):
            place = bisect_left(words_of, border[d])
            same &= prefixes[:, d] == (place if place < len(words_of) and words_of[place] == border[d] else -2)
        out |= same
    return out


class Shard:
    """The n-grams of one language that a task has met since its last flush."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.size = 0

    def add(self, own: list[bytes], coded: np.ndarray, piece: np.ndarray) -> None:
        numbers = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in own], np.int64)
        self.rows.append(grams(numbers[coded], piece).astype(np.int32))
        self.size += len(coded)

    def transducers(self, lang: str, borders: list[tuple[str, Gram]]) -> Iterator[tuple[int, Transducer]]:
        """(range, transducer) of the ranges that the n-grams fall into."""
        vocabulary = sorted(self.numbers)
        rank = np.empty(len(vocabulary) + 1, np.int64)
        rank[[self.numbers[w] for w in vocabulary]] = np.arange(len(vocabulary))
        rank[-1] = -1
        rows = rank[np.concatenate(self.rows)]
        rows, weights = summed(rows, np.ones(len(rows), np.int64))
        cut = [_place(rows, vocabulary, gram) for own, gram in borders if own == lang]
        first = bisect_left(borders, (lang,))
        for k, (lo, hi) in enumerate(zip([0, *cut], [*cut, len(rows)])):
            if lo < hi:
                yield first + k, Transducer.build(rows[lo:hi], weights[lo:hi], vocabulary)


def _place(rows: np.ndarray, vocabulary: list[bytes], gram: Gram) -> int:
    """Where n-grams from `gram` on start."""
    lo, hi = 0, len(rows)
    for d in range(LONGEST):
        if d == len(gram):
            return lo
        place = bisect_left(vocabulary, gram[d])
        column = rows[lo:hi, d]
        lo, hi = lo + int(np.searchsorted(column, place)), lo + int(np.searchsorted(column, place, "right"))
        if place == len(vocabulary) or vocabulary[place] != gram[d]:
            return lo
    return lo


def range_of(lang: str, gram: Gram, borders: list[tuple[str, Gram]]) -> int:
    return bisect_right(borders, (lang, gram))


def _range_borders(borders: list[tuple[str, Gram]], number: int, lang: str) -> list[Gram]:
    return [gram for own, gram in borders[max(number - 1, 0):number + 1] if own == lang]


def _lang(column: pa.Array) -> list[str]:
    return ["und" if x is None else x for x in column.to_pylist()]


def draw_borders(docs: DataFrame, range_words: int = RANGE_WORDS) -> list[tuple[str, Gram]]:
    """Borders between ranges of about `range_words` n-grams, from a bounded sample of documents.

    They decide where counts are summed, never what is counted.
    """
    rows = docs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            coded, piece, text = words(data, offsets)
            rows = grams(coded.indices.to_numpy().astype(np.int64), piece)
            vocabulary, langs = [*coded.dictionary.to_pylist(), None], _lang(batch.column(1))
            size = np.bincount(text, minlength=batch.num_rows)
            start = np.cumsum(size) - size
            for lang, a, n in zip(langs, start.tolist(), size.tolist()):
                taken = rows[a + np.arange(min(n, SAMPLE_GRAMS)) * n // max(min(n, SAMPLE_GRAMS), 1)]
                found = [[vocabulary[w] for w in row if w >= 0] for row in taken.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([n]), pa.array([found], pa.list_(pa.list_(pa.binary())))],
                                                 ["lang", "n", "grams"])

    share = min(1.0, SAMPLE_DOCS / max(rows, 1))
    sample = pick(docs, "text", "lang").sample(share, seed=7).mapInArrow(run, "lang string, n long, grams array<array<binary>>")
    found = sample.limit(2 * SAMPLE_DOCS).collect()
    total = sum(r.n for r in found) / share
    ranges = max(int(total / range_words), 1)
    drawn = sorted((r.lang, tuple(map(bytes, g)), r.n / len(r.grams)) for r in found for g in r.grams)
    weight = np.cumsum([d[2] for d in drawn])
    if not len(drawn):
        return []
    at = np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges)
    return sorted({(drawn[i][0], drawn[i][1]) for i in at.tolist()})


def shard_automata(docs: DataFrame, borders: list[tuple[str, Gram]], shard_words: int = SHARD_WORDS) -> DataFrame:
    """(range, lang, automaton, n): the transducers of all shards; n: the words they stand for."""
    prepare_python(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(borders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang in sorted(shards):
                for number, automaton in shards[lang].transducers(lang, sent.value):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), pa.array([lang]), pa.array([automaton.to_bytes()]),
                         ], ["range", "lang", "automaton"])
            shards.clear()

        for batch in gathered(batches):
            data, offsets = text_buffers(batch.column(0))
            coded, piece, text = words(data, offsets)
            langs = np.array(_lang(batch.column(1)), object)
            own, numbers = np.array([*coded.dictionary.to_pylist(), b""], object)[:-1], coded.indices.to_numpy().astype(np.int64)
            for lang in sorted(set(langs)):
                mine = np.flatnonzero((langs == lang)[text])
                for a in range(0, len(mine), shard_words):
                    part = mine[a:a + shard_words + LONGEST - 1]  # n-grams go on into the next stretch
                    used, coded_part = np.unique(numbers[part], return_inverse=True)
                    shard = shards.setdefault(lang, Shard())
                    shard.add(own[used].tolist(), coded_part, piece[part])
                    if a + shard_words < len(mine):
                        shard.rows[-1] = shard.rows[-1][:shard_words]
                        shard.size -= len(part) - shard_words
                        yield from flushed()
            if sum(s.size for s in shards.values()) >= shard_words:
                yield from flushed()
        yield from flushed()

    return pick(docs, "text", "lang").mapInArrow(run, "range int, lang string, automaton binary")


def merged_ranges(automata: DataFrame, borders: list[tuple[str, Gram]], least: int = LEAST) -> DataFrame:
    """(range, lang, n, counts, cut): the pruned automaton of each range, its number of words, and the prefixes that borders cut."""
    sent = automata.sparkSession.sparkContext.broadcast(borders)

    def run(table: pa.Table) -> pa.Table:
        number, lang = table["range"][0].as_py(), table["lang"][0].as_py()
        vocabulary, rows, weights = union([Transducer.from_bytes(b) for b in table["automaton"].to_pylist()])
        beside = _range_borders(sent.value, number, lang)
        pruned = PrefixCounts.prune(vocabulary, rows, weights, least, beside)
        cut = [{"phrase": list(p), "count": n} for level in pruned.phrases() for p, n, _ in level
               if any(b[:len(p)] == p for b in beside)]
        return pa.table({"range": [number], "lang": [lang], "n": [int(weights.sum())], "counts": [_counts_bytes(pruned)], "cut": [cut]},
                        schema=_RANGE)

    return automata.groupBy("range", "lang").applyInArrow(
        run, "range int, lang string, n long, counts binary, cut array<struct<phrase:array<binary>,count:long>>")


_RANGE = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("counts", pa.binary()),
                    ("cut", pa.list_(pa.struct([("phrase", pa.list_(pa.binary())), ("count", pa.int64())])))])


def _counts_bytes(counts: PrefixCounts) -> bytes:
    used = np.unique(np.concatenate([w for _, w, _ in counts.levels]))
    parts = [_pack(np.array([len(counts.vocabulary[i]) for i in used.tolist()], np.int64)), b"".join(counts.vocabulary[i] for i in used.tolist())]
    for parent, word, count in counts.levels:
        parts += [_pack(parent), _pack(np.searchsorted(used, word)), _pack(count)]
    body = np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _counts_from(blob: bytes) -> PrefixCounts:
    body = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    count = 2 + 3 * LONGEST
    ends = 8 * count + np.cumsum(np.frombuffer(body[:8 * count], "<i8"))
    parts = [body[a:b] for a, b in zip([8 * count, *ends.tolist()], ends.tolist())]
    cut = np.concatenate([[0], np.cumsum(_unpack(parts[0]))]).tolist()
    levels = [tuple(_unpack(p) for p in parts[2 + 3 * d:5 + 3 * d]) for d in range(LONGEST)]
    return PrefixCounts([parts[1][a:b] for a, b in zip(cut, cut[1:])], levels)


def _cut_totals(ranges: DataFrame) -> dict[tuple[str, Gram], tuple[int, int]]:
    """(count over all ranges, first range) of the phrases that borders cut: at most eight a border."""
    rows = ranges.select("range", "lang", F.explode("cut").alias("c")).groupBy("lang", F.col("c.phrase").alias("phrase")).agg(
        F.sum("c.count").alias("total"), F.min("range").alias("first")).collect()
    return {(r.lang, tuple(map(bytes, r.phrase))): (r.total, r.first) for r in rows}


def cut_candidates(ranges: DataFrame, borders: list[tuple[str, Gram]], totals: dict, least: int = LEAST) -> DataFrame:
    """(range of the rest, lang, phrase, a, k, l, rest): every candidate with each of its cuts."""
    sent = ranges.sparkSession.sparkContext.broadcast((borders, totals))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders, totals = sent.value
        for batch in batches:
            for number, lang, blob in zip(*[c.to_pylist() for c in batch.columns]):
                columns: list[list] = [[] for _ in range(6)]
                levels = _counts_from(blob).phrases()
                known = {p: totals.get((lang, p), (n, number)) for level in levels for p, n, _ in level}
                for phrase, (a, first) in known.items():
                    if len(phrase) < 2 or a < least or first != number:
                        continue  # a phrase that borders cut is a candidate in its first range
                    for k in range(1, len(phrase)):
                        rest = phrase[k:]
                        for column, value in zip(columns, (range_of(lang, rest, borders), lang, list(phrase), a, k, known[phrase[:k]][0])):
                            column.append(value)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT)], ["range", "lang", "phrase", "a", "k", "l"])

    return ranges.select("range", "lang", "counts").mapInArrow(run, "range int, lang string, phrase array<binary>, a long, k int, l long")


_CUT = [pa.int32(), pa.string(), pa.list_(pa.binary()), pa.int64(), pa.int32(), pa.int64()]


def rest_counts(cuts: DataFrame, ranges: DataFrame, totals: dict, salt: int = SALT) -> DataFrame:
    """`cuts` with r, the count of the words behind the cut."""
    sent = cuts.sparkSession.sparkContext.broadcast(totals)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lang = left["lang"][0].as_py() if left.num_rows else None
        rests = [tuple(p[k:]) for p, k in zip(left["phrase"].to_pylist(), left["k"].to_pylist())]
        counts = np.zeros(len(rests), np.int64)
        for blob in right["counts"].to_pylist():
            counts += _counts_from(blob).compose(rests)
        counts = [sent.value.get((lang, q), (n, 0))[0] for q, n in zip(rests, counts.tolist())]
        phrases = [b" ".join(p).decode() for p in left["phrase"].to_pylist()]
        return pa.table({"lang": left["lang"], "phrase": pa.array(phrases, pa.string()), "a": left["a"], "k": left["k"], "l": left["l"],
                         "r": pa.array(counts, pa.int64())})

    dealt = cuts.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(salt)))
    copies = ranges.select("range", "lang", "counts", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"))
    key = ["range", "lang", "salt"]
    return dealt.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(
        run, "lang string, phrase string, a long, k int, l long, r long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shard_words: int = SHARD_WORDS,
                 range_words: int = RANGE_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases."""
    spark = docs.sparkSession
    prepare_python(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/phrases-{uuid.uuid4().hex}"
    borders = draw_borders(docs, range_words)
    merged_ranges(shard_automata(docs, borders, shard_words), borders, least).write.parquet(f"{folder}/ranges")
    ranges = spark.read.parquet(f"{folder}/ranges")
    totals = _cut_totals(ranges)
    rest_counts(cut_candidates(ranges, borders, totals, least), ranges, totals).write.parquet(f"{folder}/cuts")
    cuts = spark.read.parquet(f"{folder}/cuts")
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("b")).select("lang", "phrase", "b.*")
    kept = best.join(_absorbed(cuts), ["lang", "phrase"], "left_anti")
    words_of = ranges.groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(16))).orderBy(*order)
    few = kept.withColumn("near", F.row_number().over(near)).where(F.col("near") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words_of, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _absorbed(cuts: DataFrame) -> DataFrame:
    """(lang, phrase) of candidates that a longer one which holds their words nearly always surrounds."""
    long = cuts.where("k = 1").withColumn("w", F.split("phrase", " ", -1)).where(F.size("w") > 2)
    parts = long.select("lang", F.col("a").alias("f"), F.explode(F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), s -> array_join(slice(w, s, m), ' '))))"
    )).alias("phrase"))
    widest = parts.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    whole = cuts.where("k = 1").select("lang", "phrase", "a")
    return whole.join(widest, ["lang", "phrase"]).where(
        F.col("f").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * 80).select("lang", "phrase")


def phrase_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op13_phrase_mining`."""
    return collocations(docs)


PHRASE_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
    FROM documents
), runs AS (
    SELECT row_number() OVER () AS run, lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), words AS (
    SELECT run, lang, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM runs
), starts AS (
    SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
    FROM words WINDOW o AS (PARTITION BY run ORDER BY i)
), grams AS (
    SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM starts GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM starts WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM starts WHERE w3 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM starts WHERE w4 IS NOT NULL GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1 AND f >= 30
), cuts AS (
    SELECT lang, m, phrase, a, w, k FROM candidates, (VALUES (1), (2), (3)) AS places(k) WHERE k < m
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
    FROM cuts c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.m], ' ')
), best AS (
    SELECT lang, phrase, a, l, r, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
    SELECT lang, a AS f, array_to_string(w[s:s + p - 1], ' ') AS phrase
    FROM candidates, (VALUES (2), (3)) AS sizes(p), (VALUES (1), (2), (3)) AS places(s)
    WHERE p < m AND s + p - 1 <= m
), absorbed AS (
    SELECT c.lang, c.phrase FROM candidates c JOIN parts USING (lang, phrase) WHERE 100::HUGEINT * f >= 80::HUGEINT * a
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank,
       b.phrase, a, l, r, n, score
FROM best b JOIN totals USING (lang)
WHERE NOT EXISTS (SELECT 1 FROM absorbed x WHERE x.lang = b.lang AND x.phrase = b.phrase)
QUALIFY rank <= 2000
"""
