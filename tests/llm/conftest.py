import pytest

SF = "/root/testdata/sf0.001"

#: Further columns whose names clash with the tables' and the operators' own.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, TEXT string, fingerprint string, "
          "size long, score double, c0 string")


def documents(spark, rows):
    """A documents table from (doc_id, text[, lang[, source]]) with clashing further columns."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r
        full.append((doc_id, text, lang, source, None if text is None else len(text), "other", "f", 7, 0.5, "c"))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture()
def docs(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text) of a small given table, on the driver."""
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
