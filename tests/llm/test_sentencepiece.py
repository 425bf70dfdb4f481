import random

import numpy as np
import pytest
import sentencepiece

from marketlake.llm import sentencepiece_scan as sp


@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.MODEL_FILE)


def odd_texts(n=300):
    rnd = random.Random(3)
    chars = " abtheing\n\t\r▁ßé漢字😀.,0123(){};"
    return ["", " ", "  a  b ", "\x00", "<s>", "</s><0x0A>", "漢字" * 40, "a" * 700, "thequickbrownfox" * 40] + [
        "".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library(encoder, library, sample):
    for text in odd_texts() + [t or "" for _, t in sample[:80]]:
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<i4").tolist() == library.encode(text)
        assert encoder.decode(packed) == text.replace(sp.SPACE, " ")


def chunks(text, size, context):
    s = sp.SPACE + text.replace(" ", sp.SPACE)
    n = max(1, len(s) // size)
    cuts = [k * size for k in range(n)] + [len(s)]
    return [(s[max(0, a - context):a], s[a:b], k == 0, k == n - 1) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def test_chunk_scan_equals_the_library(encoder, library, sample):
    for text in odd_texts(60) + [t or "" for _, t in sample[:12]]:
        for size in (40, 130):
            parts = chunks(text, size, 2 * encoder.longest)
            if not text or len(parts) < 2:
                continue
            matrices = [encoder.transfer(*p) for p in parts]
            out = b""
            for (enters, leaves), (before, body, _, _) in zip(sp.borders(matrices), parts):
                whole = before + body
                lo = 0 if enters < 0 else len(before) - enters // 256
                out += encoder.encode_escaped(whole[lo:len(whole) - leaves // 256])
            assert np.frombuffer(out, "<i4").tolist() == library.encode(text)


def test_products_are_associative(encoder, sample):
    text = max((t or "" for _, t in sample), key=len)[:900]
    a, b, c = [encoder.transfer(*p) for p in chunks(text, 300, 2 * encoder.longest)][:3]
    assert sp.compose(sp.compose(a, b), c) == sp.compose(a, sp.compose(b, c))


def test_tables(docs, library, sample):
    rows = [(1, "short text"), (2, None), (3, ""), (None, "x y"), (1, "short text"), (4, sample[0][1]), (5, sample[0][1]), (6, "w" * 900)]
    got = sp.encode(docs(rows), chunk_chars=100)
    assert got.columns == [*docs([]).columns, "ids"]
    found = sorted(((r[0], r[1], r["ids"]) for r in got.collect()), key=str)
    assert found == sorted(((d, t, library.encode(t or "")) for d, t in rows), key=str)
    q = sp.sentencepiece_query(docs(rows))
    assert q.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and q.where("not round_trip").count() == 0
    assert sp.sentencepiece_query(docs([])).count() == 0
