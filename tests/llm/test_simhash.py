import random

import pytest
import xxhash

from marketlake.llm import simhash
from marketlake.llm.components import connected_components


def brute_print(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    """{index: smallest index reachable}."""
    own = list(range(len(prints)))

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                own[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_print_equals_brute_force(sample):
    texts = [t for _, t in sample[:60]] + ["", None, "one", "a b c d", "A  b\tC\nd e", "ÄB äb", "x " * 50]
    for t in texts:
        assert simhash.simhash((t or "").encode()) == brute_print(t)


def test_long_texts_are_walked_in_pieces(monkeypatch, sample):
    text = " ".join(t for _, t in sample[:20])
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash, "word_pieces", lambda d: __import__("marketlake.llm.common", fromlist=["x"]).word_pieces(d, 100))
    assert simhash.simhash(text.encode()) == whole == brute_print(text)


def test_segments_miss_no_pair():
    rnd = random.Random(5)
    for radius in range(0, 8):
        parts = simhash._segments(list(range(64)), radius)
        for _ in range(400):
            flipped = set(rnd.sample(range(64), rnd.randrange(radius + 1)))
            assert any(len(flipped & set(bits)) <= r for bits, r in parts)


def test_components_of_planted_prints(spark):
    rnd = random.Random(7)
    prints = []
    for _ in range(12):  # dense groups, chains, and strangers
        centre = rnd.getrandbits(64)
        for _ in range(25):
            p = centre
            for b in rnd.sample(range(64), rnd.randrange(7)):
                p ^= 1 << b
            prints.append(p)
            if rnd.random() < 0.3:
                centre = p
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (1, 4):
        found = {r.fp: r.grp for r in simhash.fingerprint_components(
            spark.createDataFrame([(s,) for s in signed], "fp long"), bits).collect()}
        expected = brute_components(prints, bits)
        groups = {}
        for s, e in zip(signed, expected):
            assert groups.setdefault(e, found[s]) == found[s]
        assert len(set(groups.values())) == len(groups)


def test_contraction_follows_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 500), (600, 601)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 600: 600, 601: 600}


def test_few_edges_take_few_jobs(spark):
    """The driver's memory grows with its jobs: ten a round before, about six rounds for this chain."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    spark.sparkContext.setJobGroup("components", "components")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {i: 0 for i in range(301)}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("components")) <= 12


@pytest.mark.parametrize("task_edges", [5, 1000])
def test_rounds_and_one_task_agree(spark, task_edges):
    rng = random.Random(7)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200, 201), (202, 201), (None, 3)]
    least = {n: n for p in pairs if None not in p and p[0] != p[1] for n in p}
    for _ in least:
        for a, b in pairs:
            if a in least and b in least and a != b:
                least[a] = least[b] = min(least[a], least[b])
    edges = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.component for r in connected_components(edges, task_edges).collect()} == least
    if task_edges == 5:
        return
    assert connected_components(edges.limit(0), task_edges).count() == 0
    text = {f"{n:03d}": f"{c:03d}" for n, c in least.items()}
    named = edges.selectExpr("lpad(string(a), 3, '0') as a", "lpad(string(b), 3, '0') as b")
    assert {r.node: r.component for r in connected_components(named, task_edges).collect()} == text


def test_query_edges(spark, docs, sample):
    text = sample[0][1]
    rows = [(5, text), (3, text), (3, text), (None, text), (9, None), (8, ""), (7, " \n\t"), (None, "alone here it is"), (11, "some other words")]
    got = sorted(tuple(r) for r in simhash.near_duplicate_query(docs(rows)).select("component_id", "doc_id", "fingerprint").collect()
                 if r.doc_id is not None)
    assert [(c, d) for c, d, _ in got] == [(3, 3), (3, 3), (3, 5), (7, 7), (7, 8), (7, 9), (11, 11)]
    assert [f for _, d, f in got if d in (7, 8, 9)] == ["0" * 16] * 3
    assert [f for _, d, f in got if d == 5] == [f"{brute_print(text):016x}"]
    assert simhash.near_duplicate_query(docs([])).count() == 0


def test_keep_one(docs, sample):
    text = sample[0][1]
    rows = [(5, text), (3, text), (3, text), (None, text), (9, None), (None, "alone here it is"), (None, "alone here it is"), (11, "some other words")]
    kept = simhash.keep_one(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted(
        [(3, text), (9, None), (None, "alone here it is"), (11, "some other words")], key=str)


def test_keep_one_when_an_id_has_several_texts(docs, sample):
    texts = [t for _, t in sample if t and len(t) > 300]
    (a, b, c, d, e, f), near = texts[:6], texts[4].replace(" ", "  ")  # the same fingerprint, another text
    assert len(set(brute_components([brute_print(t) for t in (a, b, c, d, e, f)], 4))) == 6
    rows = [(5, a), (5, a), (5, b), (5, b), (None, b), (6, c), (6, c), (6, d), (7, e), (8, near), (8, f)]
    got = [(r[0], r[1]) for r in simhash.keep_one(docs(rows)).collect()]
    assert sorted(got) == sorted([(5, a), (5, b), (6, c), (6, d), (7, e), (8, f)])


def test_keep_one_of_unique_ids_needs_no_second_look(docs, sample):
    texts = [t for _, t in sample if t and len(t) > 300][:3]
    kept = simhash.keep_one(docs([(4, texts[0]), (2, texts[0]), (7, texts[1]), (9, texts[2])]))
    assert "row_number" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in kept.collect()) == [2, 7, 9]
