import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np

from marketlake.llm import ctw


def log_estimate(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute_scores(training, text, depth):
    """log10 probability of `text` by the recursion itself: a ratio of weighted probabilities for each bit."""
    counts = {}

    def add(store, history, byte, n=1):
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            for d in range(depth + 1):
                key = (node, history[len(history) - d:])
                a = store.setdefault(key, [0, 0])
                a[bit] += n
            node = 2 * node + bit

    def places(t):
        s = b"\xff" * depth + t + b"\xff"
        return [(s[i - depth:i], s[i]) for i in range(depth, len(s))]

    for t in training:
        for history, byte in places(t):
            add(counts, history, byte)
    children = {}
    for node, context in counts:
        if context:
            children.setdefault((node, context[1:]), set()).add(context)

    def weighted(node, context, extra):
        """log P_w with one more bit on the path of `extra` = (history, bit), or none."""
        a, b = counts.get((node, context), (0, 0))
        on_path = extra and extra[0].endswith(context)
        if on_path:
            a, b = (a + 1, b) if extra[1] == 0 else (a, b + 1)
        own = log_estimate(a, b)
        if len(context) == depth:
            return own
        below = set(children.get((node, context), ()))
        if on_path:
            below.add(extra[0][len(extra[0]) - len(context) - 1:])
        return np.logaddexp(own, sum(weighted(node, c, extra) for c in below)) - math.log(2)

    @lru_cache(maxsize=None)
    def plain(node):
        return weighted(node, b"", None)

    total = 0.0
    for history, byte in places(text):
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            total += weighted(node, b"", (history, bit)) - plain(node)
            node = 2 * node + bit
    return total / math.log(10)


def levels(training, depth):
    data, starts = ctw.stream(training, depth)
    counts = Counter()
    for keys, n in ctw.grams(training, depth):
        counts.update(dict(zip(keys.tolist(), n.tolist())))
    out = []
    for d in range(depth + 1):
        own = Counter()
        for g, n in counts.items():
            own[g & ((1 << 8 * (d + 1)) - 1)] += n
        keys = np.array(sorted({g >> 8 for g in own}) or [0])
        grid = np.zeros((len(keys), 256))
        for g, n in own.items():
            grid[np.searchsorted(keys, g >> 8), g & 255] = n
        out.append((keys, grid))
    return out


def test_scores_equal_the_recursion():
    training = [b"abracadabra", b"", b"abab", b"banana band"]
    for depth in (0, 1, 2):
        model = ctw.Model(levels(training, depth))
        texts = [b"abra", b"", b"xyz band", b"banana"]
        for text, got in zip(texts, model.score(texts)):
            assert math.isclose(got, brute_scores(training, text, depth), rel_tol=1e-5)


def test_probabilities_sum_to_one(sample):
    model = ctw.Model(levels([(t or "").encode()[:300] for _, t in sample[:5]], 2))
    assert np.allclose((10.0 ** model.scores.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_windows_do_not_matter(monkeypatch, sample):
    texts = [(t or "").encode() for _, t in sample[:20]]
    model = ctw.Model(levels(texts[:3], 2))
    whole, counts = model.score(texts), Counter()
    monkeypatch.setattr(ctw, "WINDOW", 97)
    assert np.allclose(model.score(texts), whole)
    for keys, n in ctw.grams(texts, 2):
        for k, c in zip(keys.tolist(), n.tolist()):
            counts[k] += c
    monkeypatch.setattr(ctw, "WINDOW", 1 << 20)
    (keys, n), = ctw.grams(texts, 2)
    assert counts == dict(zip(keys.tolist(), n.tolist()))


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7, 1e3, 1e9])
    assert np.allclose(ctw._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def check_base(rows, got, often):
    tokens = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, ws in tokens if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(
        math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_base_score(docs, sample, monkeypatch):
    rows = [*sample[:60], (None, None), (2001, ""), (2001, ""), (2002, "Ä B " + "long" * 40), (2003, "long" * 40)]
    got = ctw.scoring_query(docs(rows)).collect()
    check_base(rows, got, None)
    assert all(r.score < 0 for r in got)
    monkeypatch.setattr(ctw, "FREQUENT", 8)  # nearly all words by the join
    check_base(rows, ctw.scoring_query(docs(rows)).collect(), None)


def test_without_rows(docs):
    assert ctw.scoring_query(docs([])).count() == 0
    held = next(d for d in range(50) if zlib.crc32(str(d).encode()) % 7 == 2)
    r = ctw.scoring_query(docs([(held, "ab")])).first()
    assert r.held_out and r.n_known == 0 and r.base_score == 0 and math.isclose(r.score, -24 * math.log10(2), rel_tol=1e-5)


def test_every_context_counts(docs, sample, monkeypatch):
    """Scores of the whole query against the recursion and the model in memory, most positions by the join."""
    rows = [(d, (t or "")[:120]) for d, t in sample[:30]] + [(4001, "abracadabra"), (4002, "abab"), (4003, None)]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    training = [(t or "").encode().lower() for d, t in rows if not held(d)]
    want = ctw.Model(levels(training, ctw.DEPTH)).score([(t or "").encode().lower() for _, t in rows])
    monkeypatch.setattr(ctw, "FREQUENT_GRAMS", 200)
    monkeypatch.setattr(ctw, "CHUNK", 100)
    got = {r.doc_id: r for r in ctw.scoring_query(docs(rows)).collect()}
    assert any(held(d) for d, _ in rows)
    for (d, t), w in zip(rows, want):
        assert math.isclose(got[d].score, w, rel_tol=1e-5)
        assert math.isclose(got[d].bits_per_byte, -got[d].score / math.log10(2) / (len((t or "").encode()) + 1), rel_tol=1e-9)
    for d, t in [rows[0], *[r for r in rows if held(r[0])][:1]]:
        assert math.isclose(got[d].score, brute_scores(training, (t or "").encode().lower(), ctw.DEPTH), rel_tol=1e-5)


def test_frequent_share_of_a_large_table_leaves_no_context_out(spark, monkeypatch):
    """A context seen once in 100,000 places keeps its own estimate."""
    texts = ["ab" * 50_000, "qzxwvk"]
    rows = spark.createDataFrame([(False, t) for t in texts], "held_out boolean, text string")
    scores = {r.gram: r.score for r in ctw.gram_scores(ctw.gram_counts(rows)).collect()}
    want = ctw.Model(levels([t.encode() for t in texts], ctw.DEPTH))
    assert math.isclose(scores[int.from_bytes(b"qzxwvk", "big")], want.score([b"qzxwvk"])[0] - sum(
        scores[int.from_bytes((b"\xff" * 5 + b"qzxwvk\xff")[i:i + 6], "big")] for i in (0, 1, 2, 3, 4, 6)), rel_tol=1e-4)
    assert scores[int.from_bytes(b"qzxwvk", "big")] > -0.8


def test_chunks_hold_whole_contexts(monkeypatch):
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(ctw, "CHUNK", 50)
    rng = np.random.default_rng(4)
    for hot in (5, 700):
        context = np.sort(np.concatenate([rng.integers(0, 20, 300), np.full(hot, 7)]))
        grams = context << 8 | rng.integers(0, 256, len(context))
        batches = [pa.RecordBatch.from_arrays([pa.array(grams[k:k + 13])], ["gram"]) for k in range(0, len(grams), 13)]
        parts = [c[0] for c in ctw._chunks(iter(batches), 1)]
        assert np.array_equal(np.concatenate(parts), grams) and len(parts) > 3
        seen = [set((p >> 8).tolist()) for p in parts]
        assert sum(map(len, seen)) == len(set().union(*seen))
