import random
import re

import pytest
from pyspark.sql import functions as F

from marketlake.llm import mixing

from .conftest import SF


def reshared(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    left, stopped, out = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in order if s not in stopped]
        total = sum(w[s] for s in open_)
        out.update({s: left * w[s] / total for s in open_})
        over = [s for s in open_ if out[s] > most * sizes[s] + 1e-9]
        if not over:
            return out
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            stopped.add(s)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 5}, {"x": 7}, {"a": 100, "b": 3, "c": 50, "d": 900, "e": 0}, {f"s{i}": i * i for i in range(1, 20)}, {"s": 6, None: 2}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_permutation(spark):
    for n in (1, 2, 3, 10, 257):
        got = [r[0] for r in spark.range(n).select(mixing.permuted("id", f"{n}L", "99L")).collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def test_blocks_by_hand(spark):
    """Each document's taken words, from the offsets and the drawn blocks in plain Python."""
    rnd = random.Random(2)
    rows = [(i, rnd.choice("ab"), rnd.choice([0, 1, 5, 40, 300]), i) for i in range(60)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, tie long")
    placed, sums = mixing.offsets(sized, buckets=4)
    plan = mixing.targets(sums).withColumn("target", F.floor(F.col("target") + 0.5).cast("long"))
    drawn = [(r.source, r["index"], r.words) for r in mixing.slots(plan, block=16).collect()]
    place = {r.doc_id: (r.source, r.offset, r["size"]) for r in placed.collect()}
    stream = sorted((s, o, z) for s, o, z in place.values() if z)
    for (s, o, z), (t, p, _) in zip(stream, stream[1:]):
        assert p == o + z if s == t else p == 0
    goal = {r.source: (r.target, r.source_size) for r in plan.collect()}
    want = {d: goal[s][0] // goal[s][1] * z + sum(max(0, min(o + z, i * 16 + w) - max(o, i * 16)) for t, i, w in drawn if t == s)
            for d, (s, o, z) in place.items()}
    for s in goal:
        assert sum(want[d] for d in want if place[d][0] == s) == goal[s][0]
    original = mixing.offsets
    try:
        mixing.offsets = lambda sized: original(sized, 4)
        got = {r.doc_id: r.passes * r["size"] + sum(p.words for p in r.pieces or []) for r in mixing.mix(sized, block=16).collect()}
    finally:
        mixing.offsets = original
    assert got == want


def test_query(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    first, again = (sorted(map(tuple, mixing.mixing_query(t).collect())) for t in (table, table.repartition(5)))
    assert first == again and len(first) == 200
    texts = dict(table.select("doc_id", "text").collect())
    assert all(r[1] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r[0]] or "")) and 0 <= r[4] <= 2 * r[1] for r in first)
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, None, None, None), (2, "", None, "s"), (3, "x y", None, None)]
    got = sorted(map(tuple, mixing.mixing_query(docs(rows)).select("doc_id", "size", "source_size", "taken").collect()), key=str)
    assert [g[:3] for g in got] == [(1, 3, 6), (1, 3, 6), (2, 0, 6), (3, 2, 2), (None, 0, 2)]
    assert sum(g[3] for g in got) == 12 and mixing.mixing_query(docs([])).count() == 0


def test_mixed_documents(docs):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(40 * (i % 5))), "en", "ab"[i % 2]) for i in range(30)] + [
        (1, " ".join(f"w1_{k}" for k in range(40)), "en", "b"), (None, None, None, None)]
    table = docs(rows)
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    taken = {}
    for r in mixing.mixing_query(table).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    got = {}
    for r in out.collect():
        got[r[0]] = got.get(r[0], 0) + len(r[1].split())
        assert r[4] == len(r[1]) and set(r[1].split()) <= {f"w{r[0]}_{k}" for k in range(200)}
    assert got == {d: n for d, n in taken.items() if n}


def test_native(docs):
    plan = mixing.mixing_query(docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_slots_of_every_pass(docs):
    """All words of all passes lie in slots: each slot full, each pass a permutation of its source's words."""
    rows = [(i, " ".join(f"w{k}" for k in range(90 + 37 * (i % 5))), "en", "abc"[i % 3]) for i in range(24)]
    source = {r[0]: r[3] for r in rows}
    passes, slots, shards = {}, {}, set()
    for r in mixing.mixing_query(docs(rows)).collect():
        assert sum(p.words for p in r.slots) == r.taken
        for p in r.slots:
            key = (source[r.doc_id], p["pass"])
            passes.setdefault(key, []).extend((r.doc_id, p.start + k) for k in range(p.words))
            slots[(*key, p.slot)] = slots.get((*key, p.slot), 0) + p.words
            assert slots[(*key, p.slot)] <= mixing.BLOCK
            shards.add(((*key, p.slot), p.shard))
    words = {s: sum(90 + 37 * (i % 5) for i in source if source[i] == s) for s in "abc"}
    assert len(shards) == len(slots) and len({s for _, s in shards}) > 1
    assert all(len(set(taken)) == len(taken) for taken in passes.values())
    assert all(len(passes[s, n]) == words[s] for s, n in passes if (s, n + 1) in passes)
    assert any((s, 1) in passes for s in "abc")
