"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is cut into tokens: its words, longer ones in pieces of 24 characters.  Of
each window of K tokens the hashes of its inner windows of S tokens are compared; the window
is an anchor (a closed syncmer) if the smallest stands at its left or right
edge.  Whether a window is an anchor depends on that window alone, so a passage
has the same anchors wherever it stands.  The fingerprint holds every anchor of the text with the place of its
first token, in order; `placed` matches two fingerprints by anchor and difference of places over the cluster.

Likeness compares two whole fingerprints inside a row by position: a link is two neighbouring anchors and how far
apart they stand, so links are equal where both texts have the same two anchors at the same distance, wherever the
stretch stands.  The likeness is the share of all distinct links of both that both have (a fingerprint of one
anchor is its own link).

Null is the empty text.  A text without words has an empty fingerprint; one without
an anchor (it has few words) has the hashes of its tokens in their place.
Two empty fingerprints have likeness 1, an empty and another one 0.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import checkpointed, pick
from marketlake.session import checkpoint_dir

K = 5
S = 2
TOKEN = r"([^\x20\x09-\x0D]{1,24})"

#: Neighbouring ids that are sorted together: a group has this many documents at most (ids repeated aside).
GROUP_BITS = 10


def _hashes(text: str) -> Column:
    """The hash of every token of column `text`, in order."""
    return F.transform(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(1)), lambda x: F.xxhash64(x))


def with_places(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """`df` and column `out`: all anchors of column `text` in order, each a long: 31-bit hash << 32 | place of its first token."""
    h, g = f"{out}_h", f"{out}_g"
    inner = k - s + 1
    edge = " least(" + ", ".join(f"{g}[i + {j}]" for j in (0, inner - 1)) + ")"
    middle = " least(" + ", ".join(f"{g}[i + {j}]" for j in range(1, inner - 1)) + ")"
    window = ", ".join(f"{h}[i + {j}]" for j in range(k))
    small = ", ".join(f"get({h}, i + {j})" for j in range(s))
    df = df.withColumn(h, _hashes(text))
    df = df.withColumn(g, F.expr(f"transform({h}, (x, i) -> xxhash64({small}))"))
    df = df.withColumn(out, F.expr(f"""
        if(size({h}) < {k}, array(),
           transform(filter(sequence(0, size({h}) - {k}), i -> {edge} <= {middle}),
                     i -> shiftleft(shiftrightunsigned(xxhash64({window}), 33), 32) | bigint(i)))"""))
    return df.withColumn(out, F.expr(f"""
        case when size({out}) > 0 then {out}
             else transform({h}, (x, i) -> shiftleft(shiftrightunsigned(x, 33), 32) | bigint(i)) end""")).drop(h, g)


def links(places: str) -> str:
    """SQL of the links of the anchors in column `places`: neighbouring anchors and their distance, hashed to longs."""
    return f"""
        if(size({places}) < 2, transform({places}, p -> xxhash64(shiftright(p, 32))),
           transform(sequence(0, size({places}) - 2), i -> xxhash64(
               shiftright({places}[i], 32), shiftright({places}[i + 1], 32), ({places}[i + 1] & 4294967295) - ({places}[i] & 4294967295))))"""


def placed(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, shift, anchors, first, last): how many anchors of `a` stand in `b` just `shift` tokens further on.

    Each row of `pairs` has a key of its own and two arrays of anchors and places.  All anchors and all differences
    count; first and last are the outermost matching places in `a`.
    """
    sides = [pairs.select(key, F.explode(c).alias("p")).select(
        key, F.shiftright("p", 32).alias("hash"), F.col("p").bitwiseAND(F.lit((1 << 32) - 1)).alias(f"at_{n}"))
        for n, c in (("a", a), ("b", b))]
    return sides[0].join(sides[1], [key, "hash"]).groupBy(key, (F.col("at_b") - F.col("at_a")).alias("shift")).agg(
        F.count("*").alias("anchors"), F.min("at_a").alias("first"), F.max("at_a").alias("last"))


def as_text(anchors: Column) -> Column:
    """Anchors as lowercase hex: eight digits of hash and eight of place."""
    return F.lower(F.array_join(F.transform(anchors, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Likeness (0 to 1) of two columns of links."""
    return F.expr(f"""
        case when size({a}) = 0 and size({b}) = 0 then 1.0D
             when size({a}) = 0 or size({b}) = 0 then 0.0D
             else size(array_intersect({a}, {b})) / double(size(array_union({a}, {b}))) end""")


def _groups_in_order(groups: DataFrame) -> DataFrame:
    """(kind, grp, next_kind, next_grp) of distinct (kind, grp), descending, the first after the last.

    The groups are range partitioned; only the first one of each partition is ordered globally.
    """
    descending = [F.desc("kind"), F.desc("grp")]
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that a partition's number and its rows stay what they are
    dealt = checkpointed(groups.repartitionByRange(tasks, *descending).withColumn("part", F.spark_partition_id()))
    inside = dealt.withColumn("then", F.lead(F.struct("kind", "grp")).over(Window.partitionBy("part").orderBy(*descending)))
    every = Window.orderBy("part")  # one row a partition
    tops = dealt.groupBy("part").agg(F.max(F.struct("kind", "grp")).alias("here")).select(
        "part", F.coalesce(F.lead("here").over(every), F.first("here").over(
            every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return inside.join(tops, "part").withColumn("then", F.coalesce("then", "after")).select(
        "kind", "grp", F.col("then.kind").alias("next_kind"), F.col("then.grp").alias("next_grp"))


def _ordered(df: DataFrame) -> DataFrame:
    """`df` with kind (1: it has an id), ord (what it is ordered by, descending) and grp (neighbours in that order)."""
    bare = F.xxhash64("text")
    return df.withColumns({
        "kind": F.col("doc_id").isNotNull().cast("int"), "ord": F.coalesce(F.col("doc_id").cast("long"), bare)}).withColumn(
        "grp", F.when(F.col("kind") == 1, F.shiftright("ord", GROUP_BITS)).otherwise(F.shiftright("ord", 64 - 2 * GROUP_BITS)))


def with_next(rows: DataFrame, *carried: str) -> DataFrame:
    """`rows` and, as column next, the struct of `carried` of the next row by descending doc_id.

    The first row follows the last.  Equal ids go by descending text; null ids come last, by
    a hash of the text.  Neighbours meet in groups of 2^GROUP_BITS ids at most (repeated ones aside), and
    each group gets a copy of the next group's first row, so the texts are shuffled once.  The list of
    first ids has one row in 2^GROUP_BITS; it is written and read again, so that Spark knows its size
    and broadcasts it only below its threshold.
    """
    spark = rows.sparkSession
    groups = _ordered(rows.where("doc_id is not null").select("doc_id", F.lit("").alias("text"))).unionByName(
        _ordered(rows.where("doc_id is null").select("doc_id", "text"))).groupBy("kind", "grp").agg(F.max("ord").alias("ord"))
    groups = checkpointed(groups)
    firsts = _groups_in_order(groups.select("kind", "grp")).join(
        groups.withColumnsRenamed({"kind": "next_kind", "grp": "next_grp"}), ["next_kind", "next_grp"]).select(
        F.col("next_kind").alias("kind"), "ord", F.struct("kind", "grp").alias("ahead"))
    place = f"{checkpoint_dir(spark).rstrip('/')}/neighbours-{uuid.uuid4().hex}"
    firsts.write.parquet(place)
    placed = _ordered(rows).join(spark.read.parquet(place), ["kind", "ord"], "left").withColumn("at", F.explode(F.filter(F.array(
        F.struct(F.lit(0).alias("copy"), "kind", "grp"),
        F.when(F.col("ahead").isNotNull(), F.struct(F.lit(1).alias("copy"), F.col("ahead.kind"), F.col("ahead.grp")))),
        lambda x: x.isNotNull()))).drop("kind", "grp", "ahead").select("*", "at.*").drop("at")
    w = Window.partitionBy("kind", "grp").orderBy("copy", F.desc("ord"), F.desc("text"))
    return placed.withColumn("next", F.lead(F.struct(*carried)).over(w)).where("copy = 0").drop("kind", "grp", "ord", "copy")


def fingerprint_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op3_document_fingerprints`."""
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    paired = with_next(rows, "text").withColumn("next_text", F.col("next.text"))
    edited = paired.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "swap", F.floor(F.col("n_chars") / 3).cast("int")).withColumn(
        "edited", F.concat(F.expr("left(text, int(n_chars) - swap)"), F.expr("left(next_text, swap)")))
    # all three fingerprints are made behind the shuffle: only texts go through it
    placed_rows = edited
    for text, out in (("text", "places"), ("edited", "edited_places"), ("next_text", "next_places")):
        placed_rows = with_places(placed_rows, text, out)
    linked = placed_rows.withColumns({f"{c}_links": F.expr(links(c)) for c in ("places", "edited_places", "next_places")})
    return linked.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("places")).alias("fingerprint"), as_text(F.col("edited_places")).alias("edited_fingerprint"),
        likeness("places_links", "edited_places_links").alias("near_edited"),
        likeness("places_links", "next_places_links").alias("near_next"))
