import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from marketlake.llm import token_files

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", " 're", ".", ",", "é", "ü", "×", "\xa0", " ", "12", " 3", "日本", "<|endoftext|>",
         "\r\n", "!", "?", " ,", "x's", "\x1c", "\x85", "the ", " cat", "À", "​", "😀", "<|", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_files.TOKENIZER_FILE)


def _expected(rows, library):
    """doc_id -> (start, n_tokens, crc) of rows with distinct ids."""
    out, start = {}, 0
    for doc_id, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_units_give_the_ids_of_whole_texts(library):
    random.seed(5)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 25))) for _ in range(5000)]
    texts += ["", None, "a" * 20000, " " * 500, "\n" * 500 + "x", "word " * 20000]
    with open(token_files.TOKENIZER_FILE, encoding="utf-8") as f:
        encoder = token_files.UnitIds(token_files.ByteTokenizer(f.read()))
    for piece in (50, 1 << 20):
        flat, sizes = encoder.encode(pa.array(texts, pa.string()), piece)
        ends = np.cumsum(sizes)
        for text, a, b in zip(texts, ends - sizes, ends):
            assert flat[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, text[:80]


def test_store_that_starts_anew(library, monkeypatch):
    with open(token_files.TOKENIZER_FILE, encoding="utf-8") as f:
        encoder = token_files.UnitIds(token_files.ByteTokenizer(f.read()))
    encoder.store.limit = 3
    for text in ("one two three four", "two five, six one", "", "one two"):
        flat, _ = encoder.encode(pa.array([text]))
        assert flat.tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, sample, library):
    got = token_files.token_file_query(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == _expected(sample, library) and len(got) == len(sample)


def test_files_are_read_in_part(spark, docs, library):
    texts = [(i, "word %d, and more" % i * (i % 7)) for i in range(300)]
    folder = tempfile.mkdtemp(prefix="marketlake-test-") + "/t"
    token_files.write_tokens(docs(texts), folder, page_rows=20)
    stream = [i for _, x in texts for i in library.encode(x, add_special_tokens=False).ids + [2]]
    rows = sorted((r.start, r.ids) for r in token_files.read_stretch(spark, folder, 101, 1203).collect())
    assert [i for _, ids in rows for i in ids] == stream[101:1203] and rows[0][0] == 101
    assert token_files.read_stretch(spark, folder, len(stream), len(stream) + 5).count() == 0
    meta = token_files.read_tokens(spark, folder, ("doc_id", "n_tokens")).where("doc_id = 7")
    plan = meta._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,7)" in plan and meta.count() == 1
    whole = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert [i for r in whole for i in r.ids] == stream
    import glob
    for f in glob.glob(folder + "/tokens/*.parquet"):
        group = pq.ParquetFile(f).metadata
        for g in range(group.num_row_groups):
            by = {group.row_group(g).column(c).path_in_schema: group.row_group(g).column(c) for c in range(group.num_columns)}
            assert by["ids.list.element"].dictionary_page_offset and "DELTA_BINARY_PACKED" in by["doc_id"].encodings
            assert by["doc_id"].has_column_index and by["ids.list.element"].has_offset_index


def test_edges(spark, docs, library):
    rows = [(4, None), (2, ""), (2, "same"), (2, "same"), (None, "no id"), (9, "x " * 50000), (3, "tail  ")]
    got = token_files.token_file_query(docs(rows)).collect()
    own = sorted((r.start, r.n_tokens, str(r.doc_id)) for r in got)
    assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:])) and own[0][2] == "None"
    assert [o[2] for o in own] == ["None", "2", "2", "2", "3", "4", "9"]
    assert [r.n_tokens for r in got if r.doc_id == 4] == [1]
    crc = zlib.crc32(np.array(library.encode("same", add_special_tokens=False).ids + [2], "<u4").tobytes())
    assert [r.ids_crc32 for r in got if r.doc_id == 2].count(crc) == 2
    assert token_files.token_file_query(docs([])).count() == 0


def test_text_ids(spark):
    table = spark.createDataFrame([("b", "x y"), ("a", "z"), ("é", "q")], "doc_id string, text string")
    got = sorted((r.start, r.doc_id) for r in token_files.token_file_query(table).collect())
    assert [g[1] for g in got] == ["a", "b", "é"]
