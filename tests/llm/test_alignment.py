import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marketlake.llm import alignment
from marketlake.llm.token_files import TOKENIZER_FILE, byte_alphabet

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", ".", ",", "é", "ü", "×", "\xa0", "12", "日本", "<|endoftext|>", "<s>", "<0x41>",
         "\r\n", ";\r", "!", " ,", "\x1c", "the ", " cat", "À", "​", "😀", "word", "\x00"]


@pytest.fixture(scope="module")
def pair():
    a = Tokenizer.from_file(TOKENIZER_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_FILE)


def brute(rows, pair):
    """Rows of the contract, straight from its words."""
    a_model, b_model = pair
    byte = byte_alphabet()
    found = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            ids = a_model.encode(" " + text, add_special_tokens=False).ids
            a = [(i, bytes(byte[c] for c in a_model.id_to_token(i))) for i in ids]
            b = [(i, bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode())
                 for i in b_model.encode(text) for p in [b_model.id_to_piece(i)]]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a, b = [], []
        end_a, end_b = np.cumsum([len(x) for _, x in a]).tolist(), np.cumsum([len(x) for _, x in b]).tolist()
        both = sorted(set(end_a) & set(end_b))
        groups, links, at = [], [], 0
        for end in both:
            groups.append(",".join(str(i) for (i, _), e in zip(a, end_a) if at < e <= end) + "|"
                          + ",".join(str(i) for (i, _), e in zip(b, end_b) if at < e <= end))
            at = end
        for (i, x), e in zip(a, end_a):
            links += [(i, j) for (j, y), f in zip(b, end_b) if e - len(x) < f and f - len(y) < e]
        found.append((doc_id, len(a), len(b), groups, links))
    count = Counter(p for *_, links in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return sorted((str(d), a, b, len(g), len(l), sum(count[p] == top[p[0]] for p in l), sum(count[p] for p in l),
                   hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, l in found)


def columns(frame):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in frame.collect())


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.integers(0, 3, (5, 7)), rng.integers(0, 3, (7, 4))

        def sparse(m):
            starts = np.concatenate([[0], np.cumsum((m > 0).sum(1))])
            return alignment.Csr(starts, np.nonzero(m)[1], m[m > 0], m.shape[1])

        def dense(c):
            out = np.zeros((len(c.starts) - 1, c.width), int)
            out[c.rows(), c.columns] = c.values
            return out
        assert np.array_equal(dense(sparse(a).multiply(sparse(b))), a @ b)
        assert np.array_equal(dense(sparse(a).transposed()), a.T)


def test_links_are_overlaps_and_shared_groups():
    sizes_a, sizes_b = np.array([3, 1, 2, 4]), np.array([1, 3, 2, 1, 3])
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    overlap, grouped, groups = alignment.links(sizes_a, ends_a, sizes_b, ends_b)
    assert groups.tolist() == [4, 6, 10]
    assert list(zip(overlap.rows(), overlap.columns, overlap.values)) == [
        (0, 0, 1), (0, 1, 2), (1, 1, 1), (2, 2, 2), (3, 3, 1), (3, 4, 3)]
    assert list(zip(grouped.rows(), grouped.columns)) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 3), (3, 4)]


def test_odd_texts_equal_brute_force(spark, docs, pair):
    random.seed(8)
    rows = [(i, "".join(random.choice(PARTS) for _ in range(random.randint(0, 14)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "▁x"), (403, "a ▁ b"), (404, " lead"), (405, "same text"), (405, "same text"), (None, "no id"),
             (406, " "), (407, "\n"), (408, "x" * 3000)]
    expected = brute(rows, pair)
    for frequent in (alignment.FREQUENT, 40, 1):
        assert columns(alignment.alignment_query(docs(rows), frequent)) == expected, frequent


def test_given_texts_equal_brute_force(spark, sample, pair):
    short = [(d, t) for d, t in sample if len(t or "") < 6000]
    table = spark.createDataFrame(short, "doc_id long, text string")
    assert columns(alignment.alignment_query(table)) == brute(short, pair)


def test_pieces_and_a_store_that_starts_anew(monkeypatch, pair):
    monkeypatch.setattr(alignment, "PIECE_BYTES", 40)
    with open(TOKENIZER_FILE, encoding="utf-8") as f, open(alignment.MODEL_FILE, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    aligner.store.limit = 5
    text = "the cat sat on the mat, and the dog lay on the rug. " * 20
    column = pa.array([text, None, "short", text[:100]])

    def found():
        stretches = alignment._stretches(column, aligner)
        return len(stretches), alignment._document_pairs(stretches, alignment._good_texts(stretches, 4, aligner), aligner)
    many, got = found()
    monkeypatch.setattr(alignment, "PIECE_BYTES", 1 << 20)
    one, large = found()
    assert many > 20 and one == 1 and all(np.array_equal(x, y) for x, y in zip(got, large))


def test_long_text_and_empty_table(spark, docs, pair):
    text = "long words here, again and again\n" * 30000
    got = alignment.alignment_query(docs([(1, text)])).collect()[0]
    assert got.n_a == len(pair[0].encode(" " + text, add_special_tokens=False).ids) and got.n_b == len(pair[1].encode(text))
    assert got.n_best > 0 and got.count_sum == got.n_links
    assert alignment.alignment_query(docs([])).count() == 0
