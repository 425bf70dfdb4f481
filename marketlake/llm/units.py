"""Cutting texts where tokenizers cannot merge across, and encoding each distinct stretch once.

A unit is a stretch of bytes between two cuts.  Cuts stand only where no token of either tokenizer can cross and
where what follows cannot change what comes before:

* before a space or newline that follows a visible ASCII character or a letter of U+00C0-U+00FF.  A byte-level
  pre-tokenizer never joins visible characters to white space behind them, and no piece of the piece model (which is
  checked when it is loaded) holds a space behind another character, nor a newline;
* between such a letter (or an ASCII one) and one of `.,;:!?`: other classes of characters to the pre-tokenizer, and no piece
  holds such a pair.

Cuts are found on the bytes of a whole batch at once; a batch's distinct units are looked up in the worker's store, and only
new ones are encoded: many joined to one string where that is safe, their borders then found by byte lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Units kept by a worker; beyond, its store starts anew.
STORE = 1 << 20

#: Bytes of rows handled at once, where many small batches follow each other.
GATHER = 4 << 20

#: Bytes of units joined for one call of a tokenizer.
BLOCK = 1 << 15

_GRAPH = np.zeros(256, bool)
_GRAPH[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHER) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: joined until they have `size` bytes.  Empty batches are left out."""
    held, room = [], size
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            room -= batch.nbytes
        if held and room <= 0:
            yield pa.concat_batches(held)
            held, room = [], size
    if held:
        yield pa.concat_batches(held)


def text_buffers(column: pa.Array, lead: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls in between: null is empty; each text is led by `lead`."""
    values = [lead + x if x else b"" for x in column.cast(pa.large_binary()).to_pylist()]
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted places at which units start, each text's first byte among them, and the end of the data."""
    if not len(data):
        return np.zeros(1, np.int64)
    before = data[:-1]
    latin = np.zeros(len(before), bool)  # the last byte of U+00C0-U+00FF without U+00D7 and U+00F7
    latin[1:] = (data[:-2] == 0xC3) & (before[1:] >= 0x80) & (before[1:] != 0x97) & (before[1:] != 0xB7)
    at = _BLANK[data[1:]] & (_GRAPH[before] | latin)
    at |= _STOP[data[1:]] & (_LETTER[before] | latin)
    starts = np.zeros(len(data) + 1, bool)
    starts[1:-1] = at
    starts[offsets] = True
    return np.flatnonzero(starts)


def joinable(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which units (not empty, one behind another in `data`) may stand in any order without changing each other's tokens.

    They begin with white space and end in a character that cuts may follow.  U+2581, which piece models write
    as one space, would shift borders.
    """
    sizes = np.diff(ends, prepend=0)
    last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
    latin = (before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    good = _BLANK[data[ends - sizes]] & (sizes > 1) & (_GRAPH[last] | latin)
    marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else []
    good[np.searchsorted(ends, marks, "right")] = False
    return good


def encode_units(units: list[bytes], encode: Callable[[list[str]], list[list[int]]], size_of: np.ndarray,
                 guard: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, number of ids of each unit) for units whose ids have `size_of` bytes each.

    `guard` is a unit that stands in front of each string, for tokenizers that treat a string's start in a way of their
    own; an empty guard leaves units that start otherwise as they are.
    """
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    good = joinable(np.frombuffer(b"".join(units), np.uint8), np.cumsum(lengths))
    together, alone = np.flatnonzero(good), np.flatnonzero(~good)
    cut = np.flatnonzero(np.diff(np.cumsum(lengths[together]) // BLOCK)) + 1
    blocks = [*np.split(together, cut), *alone[:, None]] if len(together) else [*alone[:, None]]
    texts = [(guard + b"".join([units[i] for i in block.tolist()])).decode("utf-8") for block in blocks]
    counts, parts, skip = np.zeros(len(units), np.int64), [], len(guard)
    for block, ids in zip(blocks, encode(texts)):
        ids = np.array(ids, np.int64)
        if len(block) == 1:  # the bytes of ids may differ from the unit's
            first = int(np.searchsorted(np.cumsum(size_of[ids[:8]]), skip, "right")) if skip else 0
            counts[block] = len(ids) - first
        else:
            ends = np.cumsum(size_of[ids])
            first = int(np.searchsorted(ends, skip, "right"))
            borders = skip + np.cumsum(lengths[block])
            stops = np.searchsorted(ends, borders)
            if ends[-1] != borders[-1] or not np.array_equal(ends[stops], borders):
                raise ValueError("a token crosses two units")
            counts[block] = np.diff(stops + 1, prepend=first)
        parts.append(ids[first:])
    starts = np.cumsum(counts) - counts
    flat = np.empty(counts.sum(), np.int64)
    if blocks:
        order = np.concatenate(blocks)
        flat[spans(starts[order], counts[order])] = np.concatenate(parts)
    return flat, counts


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges (start, length), one range behind another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + shift


class Pool:
    """A growing flat array cut into numbered lists."""

    def __init__(self, dtype=np.int64):
        self.values, self.used = np.empty(1 << 12, dtype), 0
        self.starts, self.sizes, self.count = np.empty(1 << 10, np.int64), np.empty(1 << 10, np.int64), 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.values = room(self.values, self.used + len(flat))
        self.values[self.used:self.used + len(flat)] = flat
        self.starts = room(self.starts, self.count + len(sizes))
        self.sizes = room(self.sizes, self.count + len(sizes))
        self.sizes[self.count:self.count + len(sizes)] = sizes
        self.starts[self.count:self.count + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.used, self.count = self.used + len(flat), self.count + len(sizes)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, sizes) of the lists with these numbers."""
        sizes = self.sizes[numbers]
        return self.values[spans(self.starts[numbers], sizes)], sizes


def room(array: np.ndarray, size: int) -> np.ndarray:
    """`array`, or a larger copy, with at least `size` rows."""
    if size <= len(array):
        return array
    grown = np.empty((max(size, 2 * len(array)), *array.shape[1:]), array.dtype)
    grown[:len(array)] = array
    return grown


class Store:
    """Numbers of known units; `learn` is called with new units, in the order of their numbers."""

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None], limit: int = STORE):
        self.learn, self.forget, self.limit = learn, forget, limit
        self.numbers: dict[bytes, int] = {}

    def renew(self) -> None:
        """Start anew if there are too many units: numbers given before hold no longer."""
        if len(self.numbers) > self.limit:
            self.numbers.clear()
            self.forget()

    def look_up(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The number of each unit between the places `at`."""
        if len(at) < 2:
            return np.zeros(0, np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = array.dictionary_encode()
        own = coded.dictionary.to_pylist()
        known = self.numbers
        numbers = list(map(known.get, own))
        new = [unit for unit, number in zip(own, numbers) if number is None]
        if new:
            first = len(known)
            known.update(zip(new, range(first, first + len(new))))
            self.learn(new)
            fresh = iter(range(first, first + len(new)))
            numbers = [next(fresh) if n is None else n for n in numbers]
        return np.array(numbers, np.int64)[coded.indices.to_numpy()]


def pieces(at: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges (first, end) of cut numbers, each over at most about `size` bytes (more where one unit has more)."""
    lo = 0
    while lo < len(at) - 1:
        hi = int(np.searchsorted(at, at[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), len(at) - 1)
        yield lo, hi
        lo = hi
