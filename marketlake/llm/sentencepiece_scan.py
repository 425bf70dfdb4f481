"""SentencePiece encoding and decoding by a max-plus parallel scan.

Model.  A byte-pair SentencePiece model with byte fallback, identity normaliser
and dummy prefix (white space is written U+2581).  The library merges the best
scored adjacent pair again and again; a sequence of pieces is that result exactly if
every two neighbours are what merging their joined text gives
(`Encoder.fits`).  So encoding is a best path: positions are nodes with the piece
that ends there as state, an edge is worth 0 where neighbours fit and minus
infinity elsewhere, and one path is finite.  That is a max-plus product, whose
entries are kept sparse (the finite ones).

Scan.  A text longer than `chunk_chars` is split into chunk rows, spread over the
cluster.  Each chunk yields a transfer matrix between the states at its two
borders: (characters back to the last piece end, length of that piece).
Products of these matrices are associative; a text's matrices (a few hundred numbers a
chunk) are combined from both ends, which gives the one state that the whole path takes at
each border, and every chunk is then traced back on its own between its two states.
No vocabulary piece holds a character before U+2581, so a word's start is always a
border; matrices need only the stretch up to the first such place and from the last.
Without any (a giant word) they cover the whole chunk.

Shorter texts are encoded whole in one pass.  Null and empty texts have no ids.
U+2581 itself decodes to a space, as in the library.  Repeated texts give repeated
results (long ones are encoded once), an empty table an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import pick, positional, prepare_python

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 1 << 15
SPACE = "▁"
LETTERS = "A-Za-zÀ-ɏ"
BORDER = re.compile(f"(?<=[^{SPACE}]){SPACE}")

#: Entries of the unit and the pair cache of a worker; beyond, a cache starts anew.
UNIT_CACHE = 1_000_000
PAIR_CACHE = 1_000_000

#: Characters outside the vocabulary are numbered from here.
UNKNOWN = 1 << 24

Matrix = dict[int, set[int]]


class Encoder:
    """A vocabulary and the work on one string; it is sent to the workers, which keep its caches."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "piece"}
        self.rank = {p: -scores[i] for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.bytes_from = pieces.index("<0x00>")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds white space after another character")
        self.table = [bytes([i - self.bytes_from]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "piece" else b""
                      for i, (p, k) in enumerate(zip(pieces, kinds))]
        self.tails = {p[k:]: -2 for p in self.ids for k in range(1, len(p))} | self.ids  # ends of pieces; -2: not a piece
        # merging never crosses two characters that no piece holds side by side: text is cut between a letter and these
        ends = {b for p in self.ids for a, b in zip(p, p[1:]) if re.match(f"[{LETTERS}]", a)}
        stops = re.escape("".join(c for c in map(chr, range(128)) if not c.isalnum() and c not in ends))
        self.unit = re.compile(f"{SPACE}*[^{SPACE}{LETTERS}]*(?:[{LETTERS}]+[^{SPACE}{LETTERS}{stops}][^{SPACE}{LETTERS}]*)*[{LETTERS}]*")
        self.units: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, model_file: str = MODEL_FILE) -> Encoder:
        """Read a model file where the driver runs."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        every = range(m.get_piece_size())
        kinds = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "piece"
                 for i in every]
        return cls([m.id_to_piece(i) for i in every], [m.get_score(i) for i in every], kinds)

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short string: best rank first, then leftmost."""
        parts, get = list(text), self.rank.get
        ranks = [get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != np.inf:
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], np.inf)
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], np.inf)
        return parts

    def number(self, piece: str) -> int:
        """The piece's id; -1 for the text's start, and a number of its own for an unknown character."""
        return -1 if not piece else self.ids[piece] if piece in self.ids else UNKNOWN + ord(piece)

    def fits(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are where they meet ("" on the left: the start)."""
        key = self.number(left) << 32 | self.number(right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def states(self, text: str) -> tuple[list[int], list[int]]:
        """For each position of `text` the one state left there: the number and the start of the piece that ends there."""
        n, tail, pair, fits = len(text), self.tails.get, self.pairs.get, self.fits
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            for i in range(j - 1, -1, -1):
                right = tail(text[i:j])
                if right is None:  # no piece ends like this
                    if i < j - 1:
                        break
                    right = UNKNOWN + ord(text[i])
                elif right < 0:
                    if i < j - 1:
                        continue
                    right = UNKNOWN + ord(text[i])
                fit = pair(last[i] << 32 | right)
                if fit is None:
                    fit = fits(text[back[i]:i], text[i:j])
                if fit:
                    last[j], back[j] = right, i
                    break
        return last, back

    def path(self, text: str) -> list[str]:
        """The one sequence of pieces of `text`."""
        back = self.states(text)[1]
        out, j = [], len(text)
        while j:
            out.append(text[back[j]:j])
            j = back[j]
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        last, back = self.states(unit)
        ids, j = [], len(unit)
        while j:
            if last[j] < UNKNOWN:
                ids.append(last[j])
            else:
                ids.extend(self.bytes_from + b for b in chr(last[j] - UNKNOWN).encode("utf-8", "replace")[::-1])
            j = back[j]
        packed = array("i", ids[::-1]).tobytes()
        if len(unit) <= 64:
            if len(self.units) >= UNIT_CACHE:
                self.units.clear()
            self.units[unit] = packed
        return packed

    def encode_escaped(self, text: str) -> bytes:
        """Ids (packed as 4 bytes) of a text whose white space is escaped already."""
        get, new = self.units.get, self._unit
        return b"".join([get(u) or new(u) for u in self.unit.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids (packed as 4 bytes) of a whole text."""
        return self.encode_escaped(SPACE + text.replace(" ", SPACE)) if text else b""

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, without the dummy prefix."""
        table = self.table
        joined = b"".join([table[i] for i in np.frombuffer(packed, "<i4").tolist()])
        return joined[1:].decode("utf-8", "replace") if joined[:1] == b" " else joined.decode("utf-8", "replace")

    def steps(self, text: str, reached: dict[tuple[int, str], int], to: int) -> dict[tuple[int, str], int]:
        """All states (position, piece ending there) up to `to` with, as bit masks, the seeds that reach them.

        `reached` holds the seeds; only pieces that end after the last seed's position, or start from a seed, are new.
        """
        longest, ids, fits = self.longest, self.ids, self.fits
        by: dict[int, dict[str, int]] = {}
        for (at, piece), mask in reached.items():
            by.setdefault(at, {})[piece] = mask
        start = max(by, default=to)
        for j in range(start + 1, to + 1):
            here: dict[str, int] = {}
            for i in range(max(0, j - longest), j):
                before = by.get(i)
                if before and ((piece := text[i:j]) in ids or i == j - 1):
                    mask = 0
                    for left, m in before.items():
                        if fits(left, piece):
                            mask |= m
                    if mask:
                        here[piece] = mask
            if here:
                by[j] = here
        return {(at, piece): m for at, here in by.items() for piece, m in here.items()}

    def entries(self, before: str) -> list[tuple[int, str]]:
        """All states that a path may have at the end of `before`, as (position, piece)."""
        end = len(before)
        return [(j, before[i:j]) for j in range(max(1, end - self.longest + 1), end + 1)
                for i in range(max(0, j - self.longest), j) if before[i:j] in self.ids or i == j - 1]

    def transfer(self, before: str, body: str, first: bool, last: bool) -> Matrix:
        """The chunk's matrix: border state in -> border states out.

        A state is coded as characters back from the border * 256 + length of the piece; -1 is
        the text's start.  `before` has the characters in front, of two piece lengths.
        """
        text, start, end = before + body, len(before), len(before) + len(body)
        seeds = [(0, "")] if first else self.entries(before)
        code = lambda border, at, piece: (border - at) * 256 + len(piece)
        names = [-1] if first else [code(start, at, piece) for at, piece in seeds]
        cuts = [m.start() for m in BORDER.finditer(text, max(start, 1))]
        cut = next((c for c in cuts if c > start), None)
        states = self.steps(text, {s: 1 << k for k, s in enumerate(seeds)}, end if cut is None else cut)
        if cut is not None:
            states = {s: m for s, m in states.items() if s[0] == cut}
            if (final := cuts[-1]) > cut:  # from the first cut on, the path is the same for all that reach it
                everyone = 0
                for m in states.values():
                    everyone |= m
                unit = text[cuts[-2]:final]
                states = {(final, self.path(unit)[-1]): everyone} if everyone else {}
            states = self.steps(text, states, end)
        out: Matrix = {}
        for (at, piece), mask in states.items():
            if at == end or (not last and at > end - self.longest and at > start):
                for k, name in enumerate(names):
                    if mask >> k & 1:
                        out.setdefault(name, set()).add(code(end, at, piece))
        return out


def compose(left: Matrix, right: Matrix) -> Matrix:
    """Max-plus product of two sparse matrices whose finite entries are 0."""
    out = {a: set().union(*[right.get(b, ()) for b in to]) for a, to in left.items()}
    return {a: to for a, to in out.items() if to}


def borders(matrices: list[Matrix]) -> list[tuple[int, int]]:
    """(state in, state out) of each chunk on the one finite path through all."""
    ahead: list[set[int]] = [{-1}]
    run: Matrix = {-1: {-1}}
    for m in matrices:
        run = compose(run, m)
        ahead.append(run.get(-1, set()))
    behind = ahead[-1]
    states = [behind]
    for k in range(len(matrices) - 1, -1, -1):
        behind = {a for a in ahead[k] if matrices[k].get(a, set()) & behind}
        states.append(behind)
    states.reverse()
    if any(len(s) != 1 for s in states):
        raise ValueError("the chunks have no single path")
    one = [next(iter(s)) for s in states]
    return list(zip(one, one[1:]))


def _id_lists(packed: list[bytes]) -> pa.Array:
    sizes = np.cumsum([0, *[len(x) // 4 for x in packed]], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _chunks(rows: DataFrame, size: int, context: int) -> DataFrame:
    """Rows (digest, text) as chunk rows of the escaped text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                escaped = SPACE + text.replace(" ", SPACE)
                count = max(1, len(escaped) // size)  # the last chunk is the longest, so that none is shorter than a piece
                for k in range(count):
                    lo, hi = k * size, (k + 1) * size if k < count - 1 else len(escaped)
                    yield pa.RecordBatch.from_pydict({
                        "digest": [digest], "no": pa.array([k], pa.int64()), "final": [k == count - 1],
                        "before": [escaped[max(0, lo - context):lo]], "body": [escaped[lo:hi]]})

    return rows.mapInArrow(run, "digest string, no long, final boolean, before string, body string")


def _long_ids(rows: DataFrame, encoder, chunk_chars: int) -> DataFrame:
    """(digest, ids) of the long texts of rows (digest, text), one for each digest."""
    context = 2 * encoder.value.longest
    chunks = _chunks(rows.dropDuplicates(["digest"]), chunk_chars, context).repartition("digest", "no")

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [encoder.value.transfer(r["before"], r["body"], r["no"] == 0, r["final"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([[[a, *sorted(to)] for a, to in sorted(m.items())] for m in found], pa.list_(pa.list_(pa.int32())))],
                ["digest", "no", "matrix"])

    def combine(group: pa.Table) -> pa.Table:
        group = group.sort_by("no")
        path = borders([{r[0]: set(r[1:]) for r in m} for m in group["matrix"].to_pylist()])
        return pa.table({"digest": group["digest"], "no": group["no"], "enters": pa.array([a for a, _ in path], pa.int32()),
                         "leaves": pa.array([b for _, b in path], pa.int32())})

    states = chunks.mapInArrow(transfers, "digest string, no long, matrix array<array<int>>").groupBy(
        "digest").applyInArrow(combine, "digest string, no long, enters int, leaves int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for r in batch.to_pylist():
                text, start = r["before"] + r["body"], len(r["before"])
                lo = 0 if r["enters"] < 0 else start - r["enters"] // 256
                packed.append(encoder.value.encode_escaped(text[lo:len(text) - r["leaves"] // 256]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _id_lists(packed)], ["digest", "no", "ids"])

    traced = chunks.join(states, ["digest", "no"]).select(
        "digest", "no", "before", "body", "enters", "leaves").mapInArrow(trace, "digest string, no long, ids array<int>")
    return traced.groupBy("digest").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"])).alias("ids"))


def encode(docs: DataFrame, model_file: str = MODEL_FILE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """`docs` and ids, the ids of every row's whole text (a further column of that name gives way)."""
    spark = docs.sparkSession
    prepare_python(spark)
    encoder = spark.sparkContext.broadcast(Encoder.load(model_file))
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    rows = positional(docs)
    at = columns.index("text")
    text = F.col(own[at])
    size = F.char_length(F.coalesce(text, F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [encoder.value.encode(x or "") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _id_lists(packed)], [*own, "ids"])

    schema = rows.select("*", F.array().cast("array<int>").alias("ids")).schema
    short = rows.where(size <= chunk_chars).mapInArrow(run, schema)
    giant = rows.where(size > chunk_chars).withColumn("digest", F.sha2(text.cast("binary"), 256))
    long = giant.join(_long_ids(giant.select("digest", text.alias("text")), encoder, chunk_chars), "digest")
    keep = [c for i, c in enumerate(own) if columns[i] != "ids"]
    return short.unionByName(long.drop("digest")).select(*keep, "ids").toDF(*[c for c in columns if c != "ids"], "ids")


def decode(rows: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """`rows` (with ids) and `decoded`, the text of the ids; null for null ids."""
    spark = rows.sparkSession
    prepare_python(spark)
    encoder = spark.sparkContext.broadcast(Encoder.load(model_file))
    at = rows.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(at)
            flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<i4"), ids.offsets.to_numpy()
            texts = [None if null else encoder.value.decode(flat[a:b].tobytes())
                     for a, b, null in zip(ends, ends[1:], ids.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    own = positional(rows)
    return own.mapInArrow(run, own.select("*", F.lit("").alias("decoded")).schema).toDF(*rows.columns, "decoded")


def round_trips(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """`docs` with ids, n_tokens, and round_trip: whether decoding the ids gives the text back (U+2581 as a space)."""
    rows = decode(encode(docs, model_file), model_file)
    names = rows.columns
    own = positional(rows)
    columns = [own[f"c{i}"] for i in range(len(names))]
    ids, decoded = columns[-2], columns[-1]
    same = decoded == F.translate(F.coalesce(columns[names.index("text")], F.lit("")), SPACE, " ")
    kept = [c.alias(n) for c, n in zip(columns[:-1], names) if n not in ("n_tokens", "round_trip")]
    return own.select(*kept, F.size(ids).cast("long").alias("n_tokens"), same.alias("round_trip"))


def sentencepiece_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding gives the text back."""
    return decode(encode(pick(docs, "doc_id", "text"))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), SPACE, " ")).alias("round_trip"))
