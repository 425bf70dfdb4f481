"""Landing with a ledger: new and changed files alone are read, and the tables equal a fresh ingest."""
import os

import pytest

from marketlake.sources import ledger
from marketlake.sources.lake import Lake
from marketlake.sources.sinks import ingest_bronze, read_bronze_tables
from marketlake.streaming import land_new_files

SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
REVIEWS = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"


@pytest.fixture()
def folders(tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "landing")
    os.makedirs(os.path.join(land, "day 1"))
    clock = iter(range(1_700_000_000, 1_800_000_000, 60))

    def put(name, text):
        path = os.path.join(land, name)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        os.utime(path, (t := next(clock), t))
    return land, os.path.join(tmpdir_fresh, "bronze"), put


def _land(spark, land, bronze):
    return {(r.source, os.path.basename(r.file)): (r.state, r.rows, r.corrupt_rows)
            for r in ledger.land_changed(spark, land, bronze).collect()}


def _rows(spark, bronze, name, column):
    return sorted(r[0] for r in ledger.read_landed(spark, bronze, name).select(column).collect())


def test_changes_land_and_nothing_else_is_read(spark, folders):
    land, bronze, put = folders
    put("a_sellers.csv", SELLERS + "s1,01037,a,SP\ns2,02000,b\n")
    put("day 1/b[1]_sellers.csv", SELLERS + "s3,03000,c,RJ\n")
    put("order_reviews.csv", REVIEWS + 'r1,o1,5,,"two\nlines, ""quoted""",,\n')
    put("orders.csv", "no such header\n")
    put("notes.csv", "x\n1\n")
    got = _land(spark, land, bronze)
    assert got == {("sellers", "a_sellers.csv"): ("new", 2, 1), ("sellers", "b%5B1%5D_sellers.csv"): ("new", 1, 0),
                   ("order_reviews", "order_reviews.csv"): ("new", 1, 0), ("orders", "orders.csv"): ("failed", None, None),
                   (None, "notes.csv"): ("skipped", None, None)}
    assert _rows(spark, bronze, "sellers", "seller_id") == ["s1", "s2", "s3"] and _rows(spark, bronze, "orders", "order_id") == []
    first = Lake(spark, bronze).commit()
    # replaced, rewritten with the same rows, new; the unchanged part stays where it is
    put("a_sellers.csv", SELLERS + "s1,01037,z,SP\n")
    put("order_reviews.csv", REVIEWS + 'r1,o1,5,,"two\nlines, ""quoted""",,\n')
    put("geolocation.csv", "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n")
    got = _land(spark, land, bronze)
    assert got[("sellers", "a_sellers.csv")] == ("replaced", 1, 0) and got[("sellers", "b%5B1%5D_sellers.csv")] == ("unchanged", 1, 0)
    assert got[("order_reviews", "order_reviews.csv")][0] == "rewritten" and got[("geolocation", "geolocation.csv")] == ("new", 0, 0)
    assert _rows(spark, bronze, "sellers", "seller_city") == ["c", "z"]
    second = Lake(spark, bronze).commit()
    assert len(set(first.parts("sellers")) & set(second.parts("sellers"))) == 1
    # a reader of the first commit keeps its rows
    assert ledger.read_landed(spark, bronze, "sellers", first).count() == 3


def test_unchanged_files_are_not_opened(spark, folders, monkeypatch):
    land, bronze, put = folders
    put("a_sellers.csv", SELLERS + "s1,01037,a,SP\n")
    put("b_sellers.csv", SELLERS + "s2,01037,b,SP\n")
    _land(spark, land, bronze)
    opened = []
    real = ledger.read_files
    monkeypatch.setattr(ledger, "read_files", lambda s, name, paths, **o: (opened.extend(paths), real(s, name, paths, **o))[1])
    put("b_sellers.csv", SELLERS + "s2,01037,x,SP\n")
    _land(spark, land, bronze)
    assert [os.path.basename(p) for p in opened] == ["b_sellers.csv"]
    opened.clear()
    assert {v[0] for v in _land(spark, land, bronze).values()} == {"unchanged"} and not opened


def test_gone_files_failures_and_owners(spark, folders):
    land, bronze, put = folders
    put("a_sellers.csv", SELLERS + "s1,01037,a,SP\n")
    put("b_sellers.csv", SELLERS + "s2,01037,b,SP\n")
    put("products.csv", "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
                        "product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,,,,,,,,\n")
    _land(spark, land, bronze)
    os.replace(os.path.join(land, "b_sellers.csv"), os.path.join(land, "b.txt"))
    os.replace(os.path.join(land, "products.csv"), os.path.join(land, "p.txt"))
    got = _land(spark, land, bronze)
    assert got[("sellers", "b_sellers.csv")][0] == "removed" and got[("products", "products.csv")] == ("kept", 1, 0)
    assert _rows(spark, bronze, "sellers", "seller_id") == ["s1"] and _rows(spark, bronze, "products", "product_id") == ["p1"]
    put("a_sellers.csv", "seller_id,seller_city\ns9,z\n")          # fails: the rows stay, and the file is tried again
    assert _land(spark, land, bronze)[("sellers", "a_sellers.csv")][0] == "failed"
    assert _rows(spark, bronze, "sellers", "seller_id") == ["s1"]
    put("a_sellers.csv", SELLERS + "")
    assert _land(spark, land, bronze)[("sellers", "a_sellers.csv")] == ("replaced", 0, 0)
    assert _rows(spark, bronze, "sellers", "seller_id") == [] and read_bronze_tables(spark, bronze, "parquet")["products"].count() == 1
    with pytest.raises(ValueError, match="landing with a ledger"):
        ingest_bronze(spark, land, bronze, fmt="parquet")
    with pytest.raises(ValueError, match="landing with a ledger"):
        land_new_files(spark, land, bronze, "products")
    other = bronze + "-full"
    put("sellers.csv", SELLERS + "s1,01037,a,SP\n")
    ingest_bronze(spark, land, other, fmt="parquet")
    with pytest.raises(ValueError, match="full ingest"):
        ledger.land_changed(spark, land, other)


def test_compressed_files_land(spark, folders):
    import gzip

    land, bronze, put = folders
    with gzip.open(os.path.join(land, "a_sellers.csv.gz"), "wt") as f:
        f.write(SELLERS + "s1,01037,a,SP\n")
    put("b_sellers.csv", SELLERS + "s2,02000,b,SP\n")
    with gzip.open(os.path.join(land, "order_reviews.csv.gz"), "wt") as f:
        f.write(REVIEWS + 'r1,o1,5,,"two\nlines, ""quoted""",,\n')
    assert _land(spark, land, bronze) == {("sellers", "a_sellers.csv.gz"): ("new", 1, 0), ("sellers", "b_sellers.csv"): ("new", 1, 0),
                                          ("order_reviews", "order_reviews.csv.gz"): ("new", 1, 0)}
    assert _rows(spark, bronze, "sellers", "seller_id") == ["s1", "s2"]
    assert _rows(spark, bronze, "order_reviews", "review_comment_message") == ['two\nlines, "quoted"']


def test_landing_files_of_the_queries_are_compressed_and_bounded(spark, tmpdir_fresh, monkeypatch):
    from marketlake.plans import registry
    monkeypatch.setattr(registry, "LANDING_ROWS", 10)
    rows = spark.range(25).selectExpr("cast(id as string) seller_id", "'01000' seller_zip_code_prefix", "'a\n' seller_city", "'SP' seller_state")
    registry._write_landing({"sellers": rows.coalesce(1)}, tmpdir_fresh)
    files = [n for n in os.listdir(os.path.join(tmpdir_fresh, "sellers.csv")) if n.startswith("part-")]
    assert len(files) == 3 and all(n.endswith(".csv.gz") for n in files)
