import hashlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import syncmers
from marketlake.llm.common import pick


def brute_edited(rows):
    """{(doc_id, text): digest} with the next text by descending id, null ids last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        f = len(t) // 3
        out.append((d, len(t), hashlib.sha256((t[:len(t) - f] + nxt[:f]).encode()).hexdigest()))
    return out


def test_edited_texts(docs, sample):
    rows = [(d * 700, t) for d, t in sample[:40]] + [(-3, None), (5, ""), (1, "äöü"), (None, "null id")]
    got = [tuple(r) for r in syncmers.fingerprint_query(docs(rows)).select("doc_id", "n_chars", "edited_sha256").collect()]
    assert sorted(got, key=str) == sorted(brute_edited(rows), key=str)


def test_one_row_and_none(docs):
    r = syncmers.fingerprint_query(docs([(1, "abcdef ghi")])).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest() and r.near_next == 1.0
    assert syncmers.fingerprint_query(docs([])).count() == 0


def test_likeness(docs, sample):
    rows = [(d, t) for d, t in sample] + [(100_000, sample[0][1]), (100_001, ""), (100_002, None)]
    got = {r.doc_id: r for r in syncmers.fingerprint_query(docs(rows)).collect()}
    assert got[100_000].fingerprint == got[sample[0][0]].fingerprint
    assert got[100_002].near_next == got[100_001].near_edited == 1.0 and got[100_001].fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    long = [r for r in got.values() if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.35
    assert sum(r.near_next < r.near_edited for r in long) > 0.95 * len(long)


@pytest.mark.parametrize("shift", [0, 1, 3])
def test_anchors_do_not_depend_on_context(spark, shift):
    """Every anchor is what its own window of words alone says."""
    words = [f"w{i * i % 97}" for i in range(200)]
    text = " ".join([f"p{i}" for i in range(shift)] + words)
    alone = spark.createDataFrame([(" ".join(words[i:i + 5]),) for i in range(196)], "t string")
    windows = {r.a[0] >> 32 for r in syncmers.with_places(alone, "t", "a").where(F.size("a") == 1).select("a").collect()}
    whole = {p >> 32 for p in syncmers.with_places(spark.createDataFrame([(text,)], "t string"), "t", "a").first().a}
    assert windows <= whole
    assert len(whole - windows) <= shift


def test_native(docs):
    plan = syncmers.fingerprint_query(docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_shared_passage_of_long_texts_is_placed(spark, docs):
    """50 words at places 2,000 and 700 of two long texts: all their anchors are in the fingerprints, at their places."""
    passage = [f"p{i}" for i in range(50)]
    a, b = [f"a{i}" for i in range(4000)], [f"b{i}" for i in range(4000)]
    a[2000:2050], b[700:750] = passage, passage
    rows = [(1, " ".join(a)), (2, " ".join(b))]
    prints = {r.doc_id: r.fingerprint for r in syncmers.fingerprint_query(docs(rows)).collect()}
    places = {d: [int(f[i:i + 16], 16) for i in range(0, len(f), 16)] for d, f in prints.items()}
    alone = [r >> 32 for r in syncmers.with_places(spark.createDataFrame([(" ".join(passage),)], "t string"), "t", "p").first().p]
    assert len(alone) > 10 and len(places[1]) > 1000
    for d, at in ((1, 2000), (2, 700)):
        assert [p >> 32 for p in places[d] if at <= p & 0xFFFFFFFF <= at + 45] == alone
    pairs = spark.createDataFrame([(7, places[1], places[2])], "k long, a array<long>, b array<long>")
    found = {r["shift"]: r for r in syncmers.placed(pairs, "k", "a", "b").collect()}
    assert found[-1300].anchors == len(alone) and 2000 <= found[-1300]["first"] <= found[-1300]["last"] <= 2045


def brute_links(fingerprint):
    anchors = [(int(fingerprint[i:i + 8], 16), int(fingerprint[i + 8:i + 16], 16)) for i in range(0, len(fingerprint), 16)]
    if len(anchors) < 2:
        return {a for a, _ in anchors}
    return {(a, b, y - x) for (a, x), (b, y) in zip(anchors, anchors[1:])}


def brute_likeness(a, b):
    a, b = brute_links(a), brute_links(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_equals_brute_force_over_whole_fingerprints(docs, sample):
    rows = [(d * 3_000_017 % 99_999_989, t) for d, t in sample] + [(-1, "one two three four five six"), (-2, "zero one two three four five six"),
                                                                  (-3, ""), (-4, "w"), (-5, "w")]
    got = sorted(syncmers.fingerprint_query(docs(rows)).collect(), key=lambda r: -r.doc_id)
    assert len(got) == len(rows)
    for r, after in zip(got, got[1:] + got[:1]):
        assert r.near_edited == pytest.approx(brute_likeness(r.fingerprint, r.edited_fingerprint), abs=1e-12)
        assert r.near_next == pytest.approx(brute_likeness(r.fingerprint, after.fingerprint), abs=1e-12)


def test_a_passage_counts_wherever_it_stands(docs):
    words = [f"w{i}" for i in range(300)]
    rows = [(2, " ".join(words)), (1, " ".join([f"x{i}" for i in range(37)] + words))]
    got = {r.doc_id: r for r in syncmers.fingerprint_query(docs(rows)).collect()}
    assert got[2].near_next > 0.8


def test_sparse_ids_are_spread(spark, docs):
    rows = [(i * 2 ** 40 + 7, f"text {i}") for i in range(-200, 200)]
    groups = syncmers._ordered(pick(docs(rows), "doc_id", "text")).select("kind", "grp").distinct()
    found = sorted(((r.kind, r.grp), (r.next_kind, r.next_grp)) for r in syncmers._groups_in_order(groups).collect())
    own = [f[0] for f in found]
    assert [f[1] for f in found] == [own[-1], *own[:-1]] and len(own) == 400
    got = [tuple(r) for r in syncmers.fingerprint_query(docs(rows)).select("doc_id", "n_chars", "edited_sha256").collect()]
    assert sorted(got, key=str) == sorted(brute_edited(rows), key=str)
