"""Mixing sources to target weights, in DataFrame functions only.

Targets.  Sources weigh `weights` in turn (by code point, null last) and share
`share` times all words.  A target stops at `most` times its source's words and the
excess is shared anew by weight: that ends at target = min(most * size, level * weight),
and `targets` computes the level from running sums over the sources in the order in which they stop.

Blocks.  Each source is one stream of words: its documents in the order of a hash
bucket and, within it, id.  Offsets come from running sums inside the buckets plus the sums of the buckets before, so
that a source with a third of all rows is no single task.  The stream is cut into blocks of `BLOCK`
words, the last one shorter.

Draws.  A source gives target / size whole passes, and then a part of one more.  Slot
n of a pass takes the block at index P(n), P being the pass's own pseudorandom permutation of
the source's full blocks (swap-or-not, exact for any number of blocks); the short block comes last, and the last slot of
the last pass is cut so that the words reach the target to the word.  Each slot of every pass
falls on one of `shards` output shards by its hash, so a shard's counts are a multinomial
draw given the sources' totals: the totals would otherwise miss the targets by chance, and
a capped source would be read a third time.  Slots join blocks by source and index; what each document
is taken is summed from that join.  The query's column `slots` has the content of every slot: the parts (start, words) of each
document with pass, slot and shard.

No document is taken more often than its source has passes, whole or part (`most` = 2).
All draws are hashes of the seed: reruns agree.  Null texts and texts without words have
size 0 and taken 0.  Rows that repeat are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import WORD_PATTERN, checkpointed, pick, positional, spread

BLOCK = 256
BUCKETS = 1024
ROUNDS = 24
SHARDS = 64
SEED = 42
WEIGHTS = (3, 1, 2)

#: Slots are made in runs of this many, the runs dealt over the cluster.
RUN = 1 << 14


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"({WORD_PATTERN})")), F.lit(0)).cast("long")


def permuted(index: str, size: str, key: str, rounds: int = ROUNDS, seed: int = SEED) -> Column:
    """Place of `index` (0 to size-1) under the pseudorandom permutation that `key` names: swap-or-not.

    Each round pairs x with (k - x) mod size, and a bit of the hash of the pair's larger
    member says whether to swap; that is a permutation for every size.
    """
    return F.expr(f"""
        aggregate(sequence(1, {rounds}), {index}, (x, r) ->
            transform(array(pmod(pmod(xxhash64({key}, r, {seed}L), {size}) - x, {size})),
                      y -> if(pmod(xxhash64({key}, r, greatest(x, y), {seed}L), 2) = 1, y, x))[0])""")


def targets(sums: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """`sums` (source, source_size) with each source's target; one row for each source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sums.withColumn("weight", F.element_at(turn, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    # sources stop in the order of size / weight; those before this one have stopped, it and the rest share
    stop = F.col("source_size") / F.col("weight")
    before = Window.orderBy(stop, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(stop, F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    levels = weighed.withColumns({
        "_stopped": most * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "_open": F.sum("weight").over(rest),
        "_no": F.row_number().over(Window.orderBy(stop, F.col("source").asc_nulls_last())),
        "_all": share * F.sum("source_size").over(every)})
    levels = levels.withColumn("_level", (F.col("_all") - F.col("_stopped")) / F.col("_open"))
    # the level is that of the first source that it does not stop
    level = F.min(F.when(F.col("_level") * F.col("weight") <= most * F.col("source_size"),
                         F.struct("_no", F.col("_level").alias("level")))).over(every)["level"]
    return levels.withColumn("_at", level).withColumn("target", F.when(
        F.col("_at").isNull(), most * F.col("source_size")).otherwise(
        F.least(most * F.col("source_size"), F.col("_at") * F.col("weight")))).select(
        "source", "source_size", "weight", "target")


def offsets(sized: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(`sized` with `offset`, the place of each row's first word in its source's stream; the sources' sums).

    `sized` has source, doc_id, size and tie (what orders equal ids).
    """
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    sums = checkpointed(dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                         F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("from"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn(
        "offset", F.col("from") + F.col("inside")).drop("bucket", "inside", "from", "s", "b")
    return placed, sums.groupBy("source").agg(F.sum("words").alias("source_size"))


def every_slot(plan: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(source, pass, complete, slot, index, words, shard): the blocks of every pass of each source, and how much of each.

    `plan` has source and source_size, and target as whole words; the last pass may be a part (not `complete`).
    """
    whole = plan.where("source_size > 0").withColumn("whole", F.floor(F.col("target") / F.col("source_size")).cast("long"))
    named = F.xxhash64("source", F.col("source").isNull())
    part = whole.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), "whole"))).withColumn(
        "complete", F.col("pass") < F.col("whole")).withColumn(
        "part", F.when(F.col("complete"), F.col("source_size")).otherwise(F.col("target") % F.col("source_size"))).where("part > 0").withColumns({
            "full": F.floor(F.col("source_size") / block).cast("long"),
            "key": F.when(F.col("complete"), F.xxhash64(named, "pass")).otherwise(named),
            "slots": F.ceil(F.col("part") / block).cast("long")})
    runs = spread(part.withColumn("run", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / RUN).cast("long")))), "source", "pass", "run")
    every = runs.withColumn("slot", F.explode(F.sequence(
        F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("slots")) - 1)))
    return every.select(
        "source", "pass", "complete", "slot",
        F.when(F.col("slot") < F.col("full"), permuted("slot", "full", "key")).otherwise(F.col("full")).alias("index"),
        F.least(F.lit(block).cast("long"), F.col("part") - F.col("slot") * block).alias("words"),
        F.pmod(F.xxhash64("key", "slot", F.lit(SEED)), F.lit(shards)).alias("shard"))


def slots(plan: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(source, slot, index, words, shard): the slots of each source's part pass alone."""
    return every_slot(plan, block, shards).where("not complete").drop("pass", "complete")


def mix(sized: DataFrame, block: int = BLOCK, share: float = 1.5, most: float = 2.0,
        weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Each row of `sized` (doc_id, source, size, tie) with source_size, target, slots, passes and pieces.

    `slots` are the parts (pass, start, words, shard, slot, complete) of the document that the slots of all
    passes take, by pass and place in the document.  From them, `passes` counts the whole passes over the
    document, and `pieces` are the parts (start, words, shard) that the last, partial pass takes.
    """
    placed, sums = offsets(checkpointed(sized))  # texts are read once: the rest needs their sizes alone
    plan = checkpointed(targets(sums, share, most, weights))
    drawn = every_slot(plan.withColumn("target", F.floor(F.col("target") + 0.5).cast("long")), block)
    word = placed.where("size > 0").withColumn("index", F.explode(F.sequence(
        F.floor(F.col("offset") / block).cast("long"), F.floor((F.col("offset") + F.col("size") - 1) / block).cast("long"))))
    start = F.greatest(F.col("offset"), F.col("index") * block)
    end = F.least(F.col("offset") + F.col("size"), F.col("index") * block + F.col("words"))
    taken = word.join(drawn.withColumnsRenamed({"source": "s", "index": "i"}).hint("merge"),
                      F.col("source").eqNullSafe(F.col("s")) & (F.col("index") == F.col("i"))).where(end > start)
    parts = taken.groupBy("source", "offset").agg(F.sort_array(F.collect_list(F.struct(
        "pass", (start - F.col("offset")).alias("start"), (end - start).alias("words"), "shard", "slot", "complete"))).alias("slots"))
    found = placed.where("size > 0").join(
        parts.withColumnsRenamed({"source": "s", "offset": "o"}).hint("merge"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("offset") == F.col("o")), "left").drop("s", "o")
    none = placed.where("size = 0").withColumn("slots", F.lit(None).cast(found.schema["slots"].dataType))
    both = found.unionByName(none).withColumn("slots", F.expr("coalesce(slots, array())")).withColumns({
        "passes": F.expr("if(size > 0, aggregate(filter(slots, p -> p.complete), 0L, (n, p) -> n + p.words) div greatest(size, 1L), 0L)"),
        "pieces": F.expr("transform(filter(slots, p -> not p.complete), p -> struct(p.start, p.words, p.shard))")})
    return both.join(plan.select(F.col("source").alias("s"), "source_size", "target"),
                     F.col("source").eqNullSafe(F.col("s"))).drop("s", "offset")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, tie) of each row; tie is a hash of the text."""
    return pick(docs, "doc_id", "source", "text").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))


def mixing_query(docs: DataFrame) -> DataFrame:
    """The contract's columns for `op7_mixing`, and the document's parts in the slots of all passes."""
    return mix(sizes(docs)).select(
        "doc_id", "size", "source_size", "target", F.expr("aggregate(slots, 0L, (n, p) -> n + p.words)").alias("taken"),
        F.expr("transform(slots, p -> struct(p.pass, p.slot, p.shard, p.start, p.words))").alias("slots"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of `docs`: a document as often as whole passes take it, and once more cut to its pieces.

    A row that a partial pass takes whole keeps its text; else its text is the taken words,
    joined by spaces.  n_chars (where there is such a column) follows the text.  Documents without
    words are in no stream and go.
    """
    columns = docs.columns
    own = [f"c{i}" for i in range(len(columns))]
    name = dict(zip(reversed(columns), reversed(own)))
    by = positional(docs)
    text = by[name["text"]]
    keyed = by.withColumns({"doc_id": by[name["doc_id"]], "source": by[name["source"]], "tie": F.xxhash64(text)})
    # equal rows (id, source, text) have a take of their own each: number them on both sides
    same = ["doc_id", "source", "tie"]
    numbered = Window.partitionBy(*same).orderBy(F.lit(0))
    takes = mix(sizes(docs)).where("size > 0").withColumn("copy", F.row_number().over(numbered)).select(
        *[F.col(c).alias(f"k_{c}") for c in (*same, "copy")], "size", "passes", "pieces")
    rows = keyed.withColumn("copy", F.row_number().over(numbered))
    on = F.lit(True)
    for c in (*same, "copy"):
        on = on & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    joined = rows.join(takes, on).withColumn("part", F.expr("aggregate(coalesce(pieces, array()), 0L, (n, p) -> n + p.words)"))
    whole = joined.withColumn("times", F.col("passes") + (F.col("part") == F.col("size")).cast("long")).where(
        "times > 0").withColumn("time", F.explode(F.expr("sequence(1L, times)"))).select(*own)
    cut = joined.where("part > 0 and part < size").withColumn(
        "words", F.regexp_extract_all(F.col(name["text"]), F.lit(f"({WORD_PATTERN})"), F.lit(1))).withColumn(
        name["text"], F.expr("array_join(flatten(transform(pieces, p -> slice(words, int(p.start) + 1, int(p.words)))), ' ')"))
    if "n_chars" in name:
        cut = cut.withColumn(name["n_chars"], F.char_length(name["text"]).cast(docs.schema["n_chars"].dataType))
    return whole.unionByName(cut.select(*own)).toDF(*columns)
