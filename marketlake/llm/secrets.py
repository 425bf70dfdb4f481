"""Secret scans with one combined deterministic automaton.

The rules' regular expressions (ASCII; literals, classes, groups, repeats) become one
nondeterministic automaton over bytes, which subset construction turns into a
deterministic one for "any rule ends here", and partition refinement into the
smallest.  Its transition arrays are walked once over the UTF-8 bytes of a text, for all rules
together.  Where a rule ends, its reversed automaton finds the leftmost start behind
the rule's previous match, and its own automaton the longest end: leftmost,
non-overlapping matches of each rule.  That equals regular-expression search for rules
where of two overlapping matches the one that starts first also ends its shortest form first, as
all rules here do.

Every byte is walked a bounded number of times, whatever the text: the work grows with its length alone.

Null and empty texts have no spans.  Offsets are code points, ends exclusive.
Repeated rows and ids are kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import byte_values, pick, positional, prepare_python


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    A match with fewer than `tail` characters, from the first at which the pattern is complete, is
    dropped (and not searched again).  Counting them here and not by `{n,}` keeps the automaton small.
    """

    kind: str
    pattern: str
    tail: int = 1


#: The kinds in the order in which spans that start together are listed.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("hosting", r"gh[oprsu]_[A-Za-z0-9]+", 20),
)
RULES = BASE + MORE

Table = list[list[int]]


class Automaton:
    """A deterministic automaton: `table[state][byte]`, and the mask of rules that end in each state."""

    def __init__(self, table: Table, ends: list[int]):
        self.table, self.ends = table, ends

    @property
    def rows(self) -> list:
        """The states as lists that hold the next state's list for each byte, and at 256 the mask."""
        rows: list[list] = [[] for _ in self.table]
        for row, to, mask in zip(rows, self.table, self.ends):
            row.extend(rows[t] for t in to)
            row.append(mask)
        return rows


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, items: list, at: int, backwards: bool) -> int:
        """Add a parsed sequence from state `at`; its last state."""
        for kind, *args in reversed(items) if backwards else items:
            if kind == "bytes":
                to = self.state()
                self.steps[at].append((args[0], to))
                at = to
            elif kind == "group":
                to = self.state()
                for branch in args[0]:
                    self.free[self.add(branch, at, backwards)].append(to)
                at = to
            else:
                item, least, most = args
                for _ in range(least):
                    at = self.add([item], at, backwards)
                if most is None:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add([item], loop, backwards)].append(loop)
                    at = loop
                else:
                    to = self.state()
                    self.free[at].append(to)
                    for _ in range(most - least):
                        at = self.add([item], at, backwards)
                        self.free[at].append(to)
                    at = to
        return at

    def closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


class _Pattern:
    """The rules' small language: ASCII literals, `\\xHH` and escaped signs, classes with ranges, groups `(...)` and
    `(?i:...)` (letters in either case), `|`, and the repeats `?`, `*`, `+`, `{n}`, `{n,}` and `{n,m}`.

    `items` is a sequence of ("bytes", set), ("group", sequences) and ("repeat", item, least, most or None).
    """

    def __init__(self, text: str):
        self.text, self.at = text, 0
        branches = self._branches(False)
        if self.at < len(text):
            raise ValueError(f"a rule has an open {text[self.at]!r}: {text}")
        self.items = branches[0] if len(branches) == 1 else [("group", branches)]

    def _next(self) -> str:
        return self.text[self.at:self.at + 1]

    def _take(self, sign: str) -> bool:
        found = self.text.startswith(sign, self.at)
        self.at += len(sign) * found
        return found

    def _branches(self, fold: bool) -> list:
        branches = [[]]
        while self._next() not in ("", ")"):
            if self._take("|"):
                branches.append([])
            else:
                branches[-1].append(self._repeated(self._item(fold)))
        return branches

    def _item(self, fold: bool) -> tuple:
        if self._take("("):
            fold = self._take("?i:") or fold
            branches = self._branches(fold)
            if not self._take(")"):
                raise ValueError(f"a group does not end: {self.text}")
            return "group", branches
        if not self._take("["):
            if self._next() in "^$.*+?{":
                raise ValueError(f"a rule uses {self._next()!r}: {self.text}")
            return "bytes", _either_case({self._sign()}, fold)
        if self._next() == "^":
            raise ValueError(f"a rule uses a negated class: {self.text}")
        found: set[int] = set()
        while not self._take("]"):
            first = last = self._sign()
            if self._next() == "-" and self.text[self.at + 1:self.at + 2] not in ("]", ""):
                self.at += 1
                last = self._sign()
            found.update(range(first, last + 1))
        return "bytes", _either_case(found, fold)

    def _sign(self) -> int:
        if self._take("\\x"):
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        escaped = self._take("\\")
        sign = self._next()
        if not sign or escaped and sign.isalnum():
            raise ValueError(f"a rule uses an escape: {self.text}")
        self.at += 1
        return ord(sign)

    def _repeated(self, item: tuple) -> tuple:
        for sign, least, most in (("?", 0, 1), ("*", 0, None), ("+", 1, None)):
            if self._take(sign):
                return "repeat", item, least, most
        if self._take("{"):
            end = self.text.index("}", self.at)
            least, comma, most = self.text[self.at:end].partition(",")
            self.at = end + 1
            return "repeat", item, int(least), int(most) if most else None if comma else int(least)
        return item


def _either_case(found: set[int], fold: bool) -> frozenset[int]:
    if max(found) > 127:
        raise ValueError("rules are ASCII")
    return frozenset(found | {ord(c) for b in found for c in (chr(b).lower(), chr(b).upper())}) if fold else frozenset(found)


def compiled(rules: tuple[Rule, ...], search: bool, backwards: bool = False) -> Automaton:
    """The smallest automaton of `rules`; with `search` a match may start anywhere."""
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for k, rule in enumerate(rules):
        first = nfa.state()
        nfa.free[start].append(first)
        ends[nfa.add(_Pattern(rule.pattern).items, first, backwards)] = 1 << k
    if search:
        nfa.steps[start].append((frozenset(range(256)), start))
    # bytes that no step tells apart share a column
    sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
    signs = [tuple(b in s for s in sets) for b in range(256)]
    columns = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
    column = [columns[s] for s in signs]
    example = [column.index(k) for k in range(len(columns))]
    # subset construction
    known = {nfa.closed({start}): 0}
    todo, table = list(known), []
    for subset in todo:
        row = []
        for b in example:
            to = nfa.closed({t for s in subset for chars, t in nfa.steps[s] if b in chars})
            if to not in known:
                known[to] = len(known)
                todo.append(to)
            row.append(known[to])
        table.append(row)
    masks = [sum({ends[s] for s in subset if s in ends}) for subset in todo]
    # refinement: states stay together while their masks and their successors' classes agree
    grid, classes = np.array(table), np.array(masks)
    classes = np.unique(classes, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([classes, classes[grid]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == classes.max():
            break
        classes = finer
    order = {c: k for k, c in enumerate(dict.fromkeys(classes.tolist()))}  # the start stays state 0
    number = [order[c] for c in classes.tolist()]
    small: Table = [[] for _ in order]
    out = [0] * len(order)
    for s, row in enumerate(table):
        if not small[number[s]]:
            small[number[s]] = [number[row[column[b]]] for b in range(256)]
            out[number[s]] = masks[s]
    return Automaton(small, out)


class Scanner:
    """The combined automaton of some rules, and each rule's own in both directions."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.every = compiled(rules, search=True)
        self.start = self.every.rows[0]
        self.ahead = [compiled((r,), search=False) for r in rules]
        self.back = [compiled((r,), search=False, backwards=True) for r in rules]
        self.alone = [compiled((r,), search=True) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(position, mask) of all bytes at which some rule ends: the one pass."""
        found, row = [], self.start
        for at, b in enumerate(data):
            row = row[b]
            if row[256]:
                found.append((at, row[256]))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, number of the rule, end) in bytes, sorted.

        The combined automaton also reports ends of matches that began inside the rule's previous one.  A walk back
        that finds no start behind that one tells so; from then on to the rule's next match, the rule's own automaton, started
        behind the previous match, says which reports count.  So each byte is walked a bounded number of times.
        """
        behind = [0] * len(self.rules)
        doubt: list[tuple[int, int] | None] = [None] * len(self.rules)  # the own automaton's (place, state)
        out = []
        for at, mask in self.ends(data):
            for k, rule in enumerate(self.rules):
                if not mask >> k & 1 or at < behind[k]:
                    continue
                if doubt[k] is not None and not self._ends_here(k, data, at, doubt):
                    continue
                start = self._start(k, data, at, behind[k])
                if start is None:
                    doubt[k] = (behind[k], 0)
                    self._ends_here(k, data, at, doubt)
                    continue
                complete, end = self._end(k, data, start)
                behind[k], doubt[k] = end, None
                if end - complete + 1 >= rule.tail:
                    out.append((start, k, end))
        return sorted(out)

    def _ends_here(self, k: int, data: bytes, at: int, doubt: list) -> bool:
        """Take the rule's own automaton on to `at`: whether a match that starts behind the previous one ends there."""
        place, state = doubt[k]
        table = self.alone[k].table
        while place <= at:
            state = table[state][data[place]]
            place += 1
        doubt[k] = (place, state)
        return bool(self.alone[k].ends[state])

    def _start(self, k: int, data: bytes, at: int, limit: int) -> int | None:
        table, ends, state, found = self.back[k].table, self.back[k].ends, 0, None
        dead = _dead(self.back[k])
        while at >= limit:
            state = table[state][data[at]]
            if state == dead:
                break
            if ends[state]:
                found = at
            at -= 1
        return found

    def _end(self, k: int, data: bytes, at: int) -> tuple[int, int]:
        """Where the match from `at` is first complete, and where it ends at last."""
        table, ends, state, first, found = self.ahead[k].table, self.ahead[k].ends, 0, 0, 0
        dead = _dead(self.ahead[k])
        while at < len(data):
            state = table[state][data[at]]
            if state == dead:
                break
            at += 1
            if ends[state]:
                found = at
                first = first or at
        return first, found

    def text_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """`spans` in code points."""
        spans = self.spans(data)
        if spans and len(data) != (len(data.decode("utf-8", "replace"))):
            marks, at, chars = {}, 0, 0
            for edge in sorted({e for s, _, t in spans for e in (s, t)}):
                chars += len(data[at:edge].decode("utf-8", "replace"))
                at, marks[edge] = edge, chars
            spans = [(marks[s], k, marks[t]) for s, k, t in spans]
        return spans


def _dead(automaton: Automaton) -> int:
    """The state that no byte leaves and in which nothing ends, or -1."""
    dead = getattr(automaton, "dead", None)
    if dead is None:
        dead = automaton.dead = next((s for s, row in enumerate(automaton.table)
                                      if not automaton.ends[s] and set(row) == {s}), -1)
    return dead


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """The rules' scanner, built once in each worker."""
    return Scanner(rules)


def listed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, counted: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, n_<kind> of each counted rule, base_sha256 (digest of their spans) and spans (of all rules)."""
    prepare_python(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")
    names = [f"n_{r.kind}" for r in counted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        base = {k for k, r in enumerate(rules) if r in counted}
        for batch in batches:
            found = [scan.text_spans(x) for x in byte_values(batch.column(1))]
            counts = [pa.array([sum(k == rules.index(r) for _, k, _ in f) for f in found], pa.int64()) for r in counted]
            digests = [hashlib.sha256(listed([x for x in f if x[1] in base], rules).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests, pa.string()), pa.array(
                [listed(f, rules) for f in found], pa.string())], ["doc_id", *names, "base_sha256", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + "".join(f"{n} long, " for n in names) + "base_sha256 string, spans string")


def mask_text(data: bytes, scan: Scanner) -> str:
    """The text with each stretch of spans that touch replaced by the first one's kind."""
    text, out, at = data.decode("utf-8", "replace"), [], 0
    spans = scan.text_spans(data)
    k = 0
    while k < len(spans):
        start, rule, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] <= end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{scan.rules[rule].kind} removed]"]
        at = end
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with secrets in the texts masked, and n_chars (where there is such a column) counted anew.

    A null text stays null; all rows and further columns stay as they are.
    """
    prepare_python(docs.sparkSession)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for batch in batches:
            columns = list(batch.columns)
            nulls = columns[at].is_null().to_pylist()
            texts = [None if null else mask_text(x, scan) for null, x in zip(nulls, byte_values(columns[at]))]
            if size is not None:
                olds = columns[at].to_pylist()
                columns[size] = pa.array([n if new == old else len(new) for n, new, old in zip(
                    columns[size].to_pylist(), texts, olds)], columns[size].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    rows = positional(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
