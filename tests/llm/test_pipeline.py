import re
from collections import Counter

import sentencepiece

import corpus_pipeline
from marketlake.llm import mixing, quality_rules, secrets, sentencepiece_scan, simhash
from marketlake.llm.queries import QUERIES

from .conftest import SF
from .test_quality_rules import brute
from .test_simhash import brute_components, brute_print


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "secret_scans", "mixing", "sentencepiece"]
    good = corpus_pipeline.good_documents(spark, docs, SF)
    kept = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == docs.columns
    for d, r in before.items():
        n, _, _, _, repeat = brute(r.text)
        assert d not in kept or (n >= 50 and 100 * repeat <= 50 * n)
    ids = sorted(kept)
    groups = brute_components([brute_print(kept[i]) for i in ids], 4)
    want = {ids[g] for g in groups}
    distinct = corpus_pipeline.distinct_documents(spark, good, SF)
    assert {r.doc_id for r in distinct.collect()} == want and distinct.columns == docs.columns
    masked = {i: secrets.mask_text(kept[i].encode(), secrets.scanner(secrets.RULES)) for i in want}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= want and len(out) > len(want) // 2
    for r in out:
        words = masked[r.doc_id].split()
        assert r.text == masked[r.doc_id] or set(re.findall(r"[^\x20\x09-\x0D]+", r.text)) <= set(words)
        assert r.n_tokens == len(r.ids) and r.n_chars == len(r.text) and r.round_trip
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_scan.MODEL_FILE)
    assert [r.ids for r in out] == library.encode([r.text for r in out])
    # each document stands there with as many words as the mix of the stage's input takes of it
    clean = spark.createDataFrame([(i, masked[i], before[i].lang, before[i].source, len(masked[i])) for i in want], docs.schema)
    taken = {r.doc_id: r.taken for r in mixing.mixing_query(clean).collect()}
    words = Counter()
    for r in out:
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert dict(words) == {i: n for i, n in taken.items() if n}
    for r in out:
        assert words[r.doc_id] <= 2 * len(re.findall(r"[^\x20\x09-\x0D]+", masked[r.doc_id]))


def test_stages_on_edge_tables(spark, docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good = " ".join(f"word{i} and more of it," for i in range(40))
    rows = [(1, good), (1, good), (2, good), (None, good + " x"), (3, None), (4, ""), (5, "short"),
            (6, " ".join(f"other{i * i}" for i in range(30000)) + " token=abcdefgh1")]
    for table, ids in ((rows, {1, 6}), ([], set())):
        frame = docs(table)
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path))
        got = frame.collect()
        assert {r.doc_id for r in got} <= ids and (not ids or {r.doc_id for r in got})
        assert all(r.round_trip and "token=" not in r["text"] for r in got)
        assert frame.columns[:10] == docs([]).columns


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert simhash.MAX_BITS == 4 and simhash.SHINGLE_WORDS == 4 and quality_rules.MIN_WORDS == 50
