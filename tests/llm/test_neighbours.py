import zlib

import numpy as np

from marketlake.llm import neighbours as nb

SFD = "/root/testdata/sf0.01"


def test_votes_equal_brute_force(sample):
    rows = [nb.Terms().counts((t or "").encode()) for _, t in sample[:120]]
    labels = np.array([i % 3 != 0 for i in range(100)], float)
    space = nb.Space(rows[:100], labels)
    got = space.score(rows[100:])
    vectors = space.project(rows[100:]).astype(float)
    for v, s in zip(vectors, got):
        cosines = space.vectors.astype(float) @ v
        near = np.argsort(-cosines)[:nb.NEIGHBOURS]
        weights = np.maximum(cosines[near], 0) ** nb.SHARP
        assert abs(s - (weights * labels[near]).sum() / weights.sum()) < 1e-3


def test_pieces_do_not_matter(monkeypatch, sample):
    data = max((t or "" for _, t in sample), key=len).encode()
    whole = dict(zip(*map(np.ndarray.tolist, nb.Terms().counts(data))))
    monkeypatch.setattr(nb, "word_pieces", lambda d: __import__("marketlake.llm.common", fromlist=["x"]).word_pieces(d, 50))
    assert dict(zip(*map(np.ndarray.tolist, nb.Terms().counts(data)))) == whole


def test_held_out_accuracy(spark):
    table, labels = (spark.read.parquet(f"{SFD}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r for r in nb.classifier_query(table, labels).collect()}
    assert len(got) == table.count()
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert np.mean([r.predicted == q for r, q in held]) > 0.95 and all(0 <= r.score <= 1 for r, _ in held)


def test_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None), (1, None), (None, "x"), (2, ""), (3, "some words")]
    got = nb.classifier_query(docs(rows), none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    one = spark.createDataFrame([(3, 0, 0), (3, None, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert nb.classifier_query(docs(rows), one).count() == 5
    assert nb.classifier_query(docs([]), one).count() == 0


def test_a_repeated_id_is_fitted_once(spark, docs, sample, monkeypatch):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    table = docs([(1, sample[k % 3][1]) for k in range(60)] + [(2, sample[5][1])])
    monkeypatch.setattr(nb, "Space", lambda rows, quality: (len(rows), quality.tolist()))
    assert nb.fitted(table, labels) == (2, [1.0, 0.0])
