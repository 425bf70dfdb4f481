"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has 64 bits; a bit is set when more than half of the
XXH64 hashes (seed 42) of its word shingles have it set.  Two fingerprints
link at `max_bits` or fewer differing bits; groups are the connected
components of the links.

Search.  The 64 bits are cut into four segments (`_segments`; they overlap) such that two
fingerprints within four bits are within one bit in one of them at least.  Every distinct
fingerprint is stored under its value in each segment, every fingerprint probes
the Hamming ball of radius 1 around each of its values, and the fetched
pairs are verified over all 64 bits.  A segment has about 26 bits, so chance
hits stay few.  Nothing is sampled or capped.

Dense groups.  Thousands of copies with a few edits have fingerprints
within a few bits of each other, and their pairs must not be enumerated.
Fingerprints at most two bits apart share a midpoint at most one bit from
both, so `near_groups` first joins them through their 65 midpoints each (work
in proportion to the fingerprints, however dense the group).  The index search then looks only
for links between different such groups: in each bucket the group with
most members is left out on one side, so the usual bucket of a dense group has
nothing left to compare.

Null and empty texts have fingerprint zero and link like any other; repeated
rows and ids are kept; a component whose ids are all null has a null
component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import byte_values, pick, positional, prepare_python, spread, step, word_pieces
from marketlake.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42


def shingle_hashes(data: bytes, shingle: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 hashes of all word shingles, piece by piece; a shorter text is one shingle."""
    carried: list[bytes] = []
    hashed = False
    digest = xxhash.xxh64_intdigest
    for words in word_pieces(data.lower()):
        words = carried + words
        if len(words) >= shingle:
            ends = np.cumsum([len(w) + 1 for w in words])
            first = [0, *ends[:len(words) - shingle].tolist()]
            last = (ends[shingle - 1:] - 1).tolist()
            joined = b" ".join(words)
            yield np.array([digest(joined[i:j], seed) for i, j in zip(first, last)], dtype=np.uint64)
            hashed = True
        carried = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
    if carried and not hashed:
        yield np.array([digest(b" ".join(carried), seed)], dtype=np.uint64)


def simhash(data: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data, shingle):
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 15):
            part = hashes[at:at + (1 << 15)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's whole text, as a signed long."""
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(x, shingle) for x in byte_values(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = pick(docs, "doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _segments(bits: list[int], radius: int) -> list[tuple[list[int], int]]:
    """Bit sets with a radius of 1 at most, one of which any two words within `radius` bits stay within.

    Within r >= 3 bits: a first part within 1 bit, or the rest within r-2.  Within 2: cut in
    thirds, some two of them within 1 together.  The parts are sized for keys of equal width.
    """
    if radius <= 1:
        return [(bits, radius)]
    n = len(bits)
    if radius == 2:
        thirds = [bits[n * i // 3:n * (i + 1) // 3] for i in range(3)]
        return [(thirds[i] + thirds[j], 1) for i, j in ((0, 1), (0, 2), (1, 2))]
    share = {0: 1.0, 1: 1.0, 2: 2 / 3}
    for r in range(3, radius + 1):
        share[r] = share[r - 2] / (1 + share[r - 2])
    cut = round(n * share[radius])
    return [(bits[:cut], 1), *_segments(bits[cut:], radius - 2)]


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def near_groups(prints: DataFrame) -> DataFrame:
    """(node, component) of the distinct fingerprints at most two bits apart, through shared midpoints.

    The members around a midpoint are kept as a bit mask, so a group is one
    row of two longs however many members it has (65 at most).
    """
    around = spread(prints, "fp").select(
        "fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("i")
    ).select(
        F.when(F.col("i") < 0, F.col("fp")).otherwise(F.expr("fp ^ shiftleft(1L, i)")).alias("z"),
        F.when(F.col("i") < 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, i)")).alias("bit"),
        F.when(F.col("i") < 0, 1).otherwise(0).alias("self"))
    met = around.groupBy("z").agg(F.bit_or("bit").alias("mask"), F.max("self").alias("self")).where(
        F.bit_count("mask") + F.col("self") > 1)
    members = met.select("z", F.expr("""
        concat(if(self = 1, array(z), array()),
               transform(filter(sequence(0, 63), i -> getbit(mask, i) = 1), i -> z ^ shiftleft(1L, i)))""").alias("of"))
    edges = members.select(F.array_min("of").alias("a"), F.explode("of").alias("b"))
    return connected_components(edges)


def links_between(groups: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): pairs of different `grp` values of `groups` (fp, grp) with fingerprints within `max_bits`."""
    parts = [(sum(1 << i for i in bits), bits, radius) for bits, radius in _segments(list(range(64)), max_bits)]
    def keyed(rows: DataFrame, entries: list[tuple[int, int, int]]) -> DataFrame:
        """(fp, grp, seg, key) of each row for each (segment, its mask, bits to flip); the list is a literal, not code."""
        listed = F.array(*[F.struct(F.lit(no).alias("seg"), F.lit(_signed(mask)).cast("long").alias("mask"),
                                    F.lit(_signed(flip)).cast("long").alias("flip")) for no, mask, flip in entries])
        return rows.select("fp", "grp", F.explode(listed).alias("e")).select(
            "fp", "grp", F.col("e.seg").alias("seg"),
            F.col("fp").bitwiseAND(F.col("e.mask")).bitwiseXOR(F.col("e.flip")).alias("key"))

    stored = keyed(groups, [(no, mask, 0) for no, (mask, _, _) in enumerate(parts)])
    probes = keyed(spread(groups, "fp"), [(no, mask, flip) for no, (mask, bits, radius) in enumerate(parts)
                                          for flip in [0, *[1 << i for i in bits if radius]]])
    where = ["seg", "key"]
    main = stored.groupBy(*where, "grp").agg(F.count("*").alias("n")).groupBy(*where).agg(
        F.max_by("grp", F.struct("n", "grp")).alias("main"), F.count("*").alias("groups"))
    table = stored.join(main.hint("merge"), where).select(
        *where, F.col("fp").alias("other"), F.col("grp").alias("other_grp"),
        (F.col("grp") != F.col("main")).cast("int").alias("minor"))
    # a probe of the bucket's main group meets the other groups only
    asked = probes.join(main.hint("merge"), where).where((F.col("groups") > 1) | (F.col("grp") != F.col("main"))).select(
        *where, "fp", "grp",
        F.explode(F.when(F.col("grp") == F.col("main"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("minor"))
    met = asked.join(table.hint("merge"), (asked["seg"] == table["seg"]) & (asked["key"] == table["key"])
                     & (asked["minor"] == table["minor"])
                     & (F.col("grp") != F.col("other_grp"))
                     & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits))
    return met.select(F.least("grp", "other_grp").alias("a"), F.greatest("grp", "other_grp").alias("b")).distinct()


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, grp): the component of every distinct fingerprint of `prints` (column fp)."""
    distinct = step(prints.select("fp").distinct())
    if max_bits >= 2:
        close = near_groups(distinct)
        groups = step(distinct.join(close.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select(
            "fp", F.coalesce("component", "fp").alias("grp")))
    else:
        groups = distinct.select("fp", F.col("fp").alias("grp"))
    joined = connected_components(links_between(groups, max_bits))
    return groups.join(joined.withColumnRenamed("node", "grp").hint("merge"), "grp", "left").select(
        "fp", F.coalesce("component", "grp").alias("grp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fp, grp (component as a fingerprint), component_id (smallest doc_id)."""
    prints = step(fingerprints(docs, shingle))
    grouped = step(fingerprint_components(prints, max_bits))
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(grouped.hint("merge"), "fp")
    first = ids.groupBy("grp").agg(F.min("least").alias("component_id"))
    names = grouped.join(first.hint("merge"), "grp").select("fp", "grp", "component_id")
    return prints.join(names.hint("merge"), "fp").select("doc_id", "fp", "grp", "component_id")


def near_duplicate_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op1_simhash_near_dedup`."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one document of each near-duplicate group: that of the smallest doc_id.

    Of several rows of the group with that id one stays, of the smallest fingerprint.  Documents without an id
    stay only in groups where no document has one, again one row for each group.  An id that stands on
    several rows says nothing about the group: such rows (and those without id) are found by id and fingerprint.
    """
    prints = near_duplicates(docs, shingle, max_bits)
    totals = prints.groupBy("doc_id").agg(F.count("*").alias("rows")).withColumnRenamed("doc_id", "id")
    heads = step(prints.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                         .groupBy("grp", "doc_id").agg(F.min("fp").alias("head_fp"))
                         .join(totals, F.col("doc_id").eqNullSafe(F.col("id")))
                         .select("grp", F.col("doc_id").alias("head"), "head_fp", "rows"))
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    by = positional(docs)
    key = by[own[columns.index("doc_id")]]
    alone = heads.where((F.col("rows") == 1) & F.col("head").isNotNull())
    shared = heads.where((F.col("rows") > 1) | F.col("head").isNull())
    one = by.join(alone.select("head"), key == F.col("head"), "left_semi")
    if shared.isEmpty():
        # every id stands on one row: the driver need not plan and compile the rest
        return one.toDF(*columns)
    unclear = by.join(shared.select("head").distinct(), key == F.col("head"), "left_semi").unionByName(by.where(key.isNull()))
    marked = _with_print(unclear, own[columns.index("text")], shingle)
    some = marked.join(shared, marked[own[columns.index("doc_id")]].eqNullSafe(F.col("head"))
                       & (F.col("fp") == F.col("head_fp")))
    # rows of one id and fingerprint may still differ: the choice between them does not depend on the run
    rank = Window.partitionBy("grp").orderBy(F.xxhash64(own[columns.index("text")]), F.xxhash64(*own))
    some = some.withColumn("__rank", F.row_number().over(rank)).where(F.col("__rank") == 1).select(*own)
    return one.unionByName(some).toDF(*columns)


def _with_print(rows: DataFrame, text: str, shingle: int) -> DataFrame:
    """`rows` and the fingerprint fp of column `text`."""
    prepare_python(rows.sparkSession)
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(x, shingle) for x in byte_values(batch.column(at))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "fp"])

    schema = rows.select("*", F.lit(0).cast("long").alias("fp")).schema
    return rows.mapInArrow(run, schema)
