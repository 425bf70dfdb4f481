import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from marketlake.llm import phrases


def count_words(texts):
    """n-gram -> count, straight from the definition."""
    out = Counter()
    for text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            for i in range(len(w)):
                for m in range(1, 5):
                    if i + m <= len(w):
                        out[tuple(w[i:i + m])] += 1
    return out


def brute(rows, least=30, top=2000):
    by = {}
    for _, text, lang in rows:
        by.setdefault("und" if lang is None else lang, []).append(text)
    out = []
    for lang, texts in by.items():
        f = count_words(texts)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[s:s + m] for p, a in found.items() for m in range(2, len(p)) for s in range(len(p) - m + 1)
                if 100 * a >= 80 * found[p[s:s + m]]}
        ranked = []
        for p, a in found.items():
            if p in gone:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(v for p, v in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -score) for i, (score, a, p, x, y) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def _texts(seed, n):
    rng = random.Random(seed)
    names = ["a", "b", "c", "the", "of", "x-1", "é", "ſ", "日本", "B", "The"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\xa0", "; "]
    return ["".join(rng.choice(names[:rng.randint(2, len(names))]) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_query_equals_brute_force_whatever_the_shards_and_ranges(spark, docs):
    rows = [(i, t, [None, "en", "de", "und", "e"][i % 5]) for i, t in enumerate(4 * _texts(1, 60) + 8 * _texts(2, 50) + 155 * _texts(9, 9))] + [(900, None, "en"), (901, "", "fr")]
    expected = brute(rows)
    assert len(expected) > 100 and any(len(r[2].split()) == 4 for r in expected)
    table = docs([(*r, None) for r in rows]).repartition(3)
    for shard_words, range_words in ((1 << 20, 1 << 20), (50, 40), (7, 300)):
        assert found(phrases.collocations(table, shard_words=shard_words, range_words=range_words)) == expected, (shard_words, range_words)
    short = found(phrases.collocations(table, top=5))
    assert short == [r for r in expected if r[1] <= 5]


def test_given_tables_equal_sql(spark):
    table = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{table}'")
    assert found(phrases.phrase_query(spark.read.parquet(table))) == sorted(con.sql(phrases.PHRASE_SQL).fetchall())


def test_transducer_round_trip_and_sharing():
    texts = _texts(4, 60)
    numbers = phrases.Shard()
    for text in texts:
        data, offsets = np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())])
        coded, piece, _ = phrases.words(data, offsets)
        numbers.add(coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), piece)
    (_, built), = numbers.transducers("en", [])
    rows, weights = phrases.Transducer.from_bytes(built.to_bytes()).paths()
    got = {tuple(built.vocabulary[w].decode() for w in r if w >= 0): n for r, n in zip(rows.tolist(), weights.tolist())}
    runs = Counter()
    for text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            runs.update(tuple(w[i:i + 4]) for i in range(len(w)))
    assert got == runs
    states = [len(s) - 1 for s in built.starts]
    assert states[3] < len({r[:3] for r in runs if len(r) == 4} | {r for r in runs if len(r) < 4})  # equal states are one
    vocabulary, rows, weights = phrases.union([built, built])
    assert weights.sum() == 2 * sum(runs.values()) and vocabulary == sorted(vocabulary) and len(rows) == len(runs)


def test_composition_finds_only_kept_prefixes():
    rows = np.array([[0, 1, -1, -1], [0, 1, 2, -1], [1, -1, -1, -1]])
    counts = phrases.PrefixCounts.prune([b"a", b"b", b"c"], rows, np.array([3, 4, 9]), 5, [])
    assert counts.compose([(b"a",), (b"a", b"b"), (b"a", b"b", b"c"), (b"b",), (b"c",), (b"a", b"zz"), (b"b", b"a")]).tolist() == [7, 7, 0, 9, 0, 0, 0]
    kept = phrases.PrefixCounts.prune([b"a", b"b", b"c"], rows, np.array([3, 4, 9]), 5, [(b"a", b"b", b"c", b"c")])
    again = phrases._counts_from(phrases._counts_bytes(kept))
    assert again.compose([(b"a", b"b", b"c"), (b"b",)]).tolist() == [4, 9]


def test_numbers_beyond_64_bits_and_edges(spark, docs):
    row = spark.createDataFrame([(9 * 10 ** 15, 9 * 10 ** 15 + 1, 9 * 10 ** 15 + 2)], "a long, l long, r long")
    from pyspark.sql import functions as F
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    assert row.select(score.cast("long")).first()[0] == 2000000 * 9 * 10 ** 15 // (18 * 10 ** 15 + 3)
    assert phrases.phrase_query(docs([])).count() == 0
    assert phrases.phrase_query(docs([(1, None), (2, ""), (3, "few words")])).count() == 0
    long = "one two three four five. " * 40000
    got = found(phrases.phrase_query(docs([(1, long, "en", None), (1, long, "en", None)])))
    assert got == brute([(1, long, "en"), (1, long, "en")]) and got[0][3] == 80000
