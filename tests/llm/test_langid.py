import zlib

import numpy as np

from marketlake.llm import langid

SFD = "/root/testdata/sf0.01"


def test_bundle_equals_its_definition():
    store = langid.Store(64)
    text = "Ab c1Éd"
    letters = {c: store.letter(ord(c)).astype(int) for c in " abcéd"}
    total = np.zeros(64, int)
    for run in (" ab c éd ",):
        for a, b, c in zip(run, run[1:], run[2:]):
            total += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    assert np.array_equal(store.bundles([text])[0], total)


def test_pieces_do_not_matter(monkeypatch, sample):
    text = max((t or "" for _, t in sample), key=len)
    whole = np.sort(np.concatenate(list(langid.trigrams(text))))
    monkeypatch.setattr(langid, "PIECE", 37)
    assert np.array_equal(np.sort(np.concatenate(list(langid.trigrams(text)))), whole)


def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SFD}/documents.parquet")
    langs = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    got = langid.language_query(table).collect()
    assert len(got) == len(langs) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held if langs[r.doc_id]]) > 0.98


def test_edges(docs):
    train = [d for d in range(40) if zlib.crc32(str(d).encode()) % 4 != 2]
    rows = [(train[0], "the cat and the dog", "en", None), (train[1], "der hund und die katze", "de", None), (train[2], "xx", None, None),
            (train[3], None, "fr", None), (100, "the dog", None, None), (100, "the dog", None, None), (101, None, None, None),
            (102, "12 !?", "en", None), (None, "die katze", None, None)]
    got = sorted(((str(r.doc_id), r.lang_pred, r.score > 0) for r in langid.language_query(docs(rows)).collect()))
    assert [g[1:] for g in got if g[0] == "100"] == [("en", True)] * 2 and ("None", "de", True) in got
    assert [g[1:] for g in got if g[0] in ("101", "102")] == [("und", False)] * 2
    assert langid.language_query(docs([])).count() == 0
    assert {r.lang_pred for r in langid.language_query(docs([(1, "words", None, None)])).collect()} == {"und"}
