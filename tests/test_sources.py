"""CSV landing sources, discovery and bronze ingest."""
import os

from marketlake.sources.lake import Lake
from marketlake.plans import staging
from marketlake.sources import csv as csv_src
from marketlake.sources import sinks


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


REVIEWS = ('review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
           'r1,o1,5,,"Chegou, tudo ""ok""\nobrigado",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
           'r2,o2,abc,,,2018-03-10 00:00:00,\n')


def test_multiline_reviews_and_string_zip(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "order_reviews.csv", REVIEWS)
    _write(tmpdir_fresh, "customers.csv", "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                                          "c1,u1,01037,sao paulo,SP\n")
    rev = staging.stg_order_reviews(csv_src.read_bronze(spark, tmpdir_fresh, "order_reviews"))
    rows = {r.review_key: r for r in rev.collect()}
    assert rows["r1"].comment_message == 'Chegou, tudo "ok"\nobrigado'
    assert rows["r2"].review_score is None
    cust = staging.stg_customers(csv_src.read_bronze(spark, tmpdir_fresh, "customers")).first()
    assert cust.zip_code_prefix == "01037"


def test_discover_landing(spark, tmpdir_fresh):
    assert csv_src.discover_landing(spark, os.path.join(tmpdir_fresh, "missing")).first().status == "missing"
    os.makedirs(os.path.join(tmpdir_fresh, "empty"))
    assert csv_src.discover_landing(spark, os.path.join(tmpdir_fresh, "empty")).first().status == "empty"
    _write(tmpdir_fresh, "a.csv", "x\n1\n")
    _write(tmpdir_fresh, "b.txt", "x\n")
    found = csv_src.discover_landing(spark, tmpdir_fresh).collect()
    assert [r.file_name for r in found] == ["a.csv"]


def test_ingest_bronze_manifest_continues_after_failure(spark, tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "landing")
    _write(land, "order_reviews.csv", REVIEWS)
    manifest = {r.source: r for r in sinks.ingest_bronze(spark, land, os.path.join(tmpdir_fresh, "bronze"), fmt="parquet").collect()}
    assert manifest["order_reviews"].status == "succeeded" and manifest["order_reviews"].rows == 2
    assert manifest["orders"].status == "failed" and manifest["orders"].error
    assert len([s for s in manifest if s]) == 9


def test_job_entry_point_build_and_check(spark, tmpdir_fresh):
    """CSV landing -> ingest -> layered build from bronze -> check, through the job entry point."""
    import pytest

    from marketlake.__main__ import main
    from marketlake.plans.quality import QualityError
    from marketlake.plans.registry import bronze_from_testdata
    from marketlake.sources.catalog import SOURCES
    from conftest import SF_SMOKE
    land = os.path.join(tmpdir_fresh, "landing")
    bronze = bronze_from_testdata(spark, SF_SMOKE)
    for name, src in SOURCES.items():
        file_name = "my_orders.csv" if name == "orders" else src.file_name
        (bronze[name].write.option("header", "true").option("quote", '"').option("escape", '"')
         .csv(os.path.join(land, file_name)))
    assert main(["ingest", "--landing", land, "--bronze", os.path.join(tmpdir_fresh, "bronze")]) == 1
    assert main(["ingest", "--landing", land, "--bronze", os.path.join(tmpdir_fresh, "bronze"),
                 "--file", "orders=my_orders.csv"]) == 0
    out = os.path.join(tmpdir_fresh, "marts")
    assert main(["build", "--bronze", os.path.join(tmpdir_fresh, "bronze"), "--out", out, "--no-gate"]) == 0
    assert Lake(spark, out).read("gold_executive_overview").count() > 0
    with pytest.raises(QualityError, match="stg_order_reviews__review_score"):
        main(["check", "--out", out])          # the unparsable review scores fail not_null
    assert main(["scenario", "--out", out, "--states", "SP", "RJ", "--max-days", "25"]) == 0


def test_write_table_partitioned_bucketed_and_views(spark, tmpdir_fresh):
    df = spark.createDataFrame([("o1", "SP", 1), ("o2", "RJ", 2), ("o3", "SP", 3)],
                               "order_key string, state string, n int")
    part = sinks.write_table(df, os.path.join(tmpdir_fresh, "by_state"), "parquet", partition_by=["state"])
    assert {d for d in os.listdir(os.path.join(tmpdir_fresh, "by_state")) if d.startswith("state=")} == \
        {"state=SP", "state=RJ"}
    assert part.filter("state = 'SP'").count() == 2
    bucketed = sinks.write_table(df, os.path.join(tmpdir_fresh, "bucketed"), "parquet",
                                 bucket_by=("order_key", 2), table="t_bucketed_test")
    assert bucketed.count() == 3
    detail = spark.sql("DESCRIBE TABLE EXTENDED t_bucketed_test").collect()
    assert any(r.col_name == "Num Buckets" and r.data_type == "2" for r in detail)
    sinks.register_views({"v_orders_test": df})
    assert spark.sql("SELECT sum(n) AS s FROM v_orders_test").first().s == 6


def test_columns_are_found_by_header(spark, tmpdir_fresh):
    _write(tmpdir_fresh, "sellers.csv", "seller_city,seller_id,extra,seller_state,seller_zip_code_prefix\nrio,s1,x,RJ,20000\n")
    r = csv_src.read_bronze(spark, tmpdir_fresh, "sellers").first()
    assert (r.seller_id, r.seller_zip_code_prefix, r.seller_city, r.seller_state) == ("s1", "20000", "rio", "RJ")
    _write(tmpdir_fresh, "sellers.csv", "seller_city,seller_id\nrio,s1\n")
    manifest = {r.source: r for r in sinks.ingest_bronze(spark, tmpdir_fresh, os.path.join(tmpdir_fresh, "b"), fmt="parquet").collect()}
    assert manifest["sellers"].status == "failed" and "seller_state" in manifest["sellers"].error


def test_rows_with_wrong_fields_are_kept_and_counted(spark, tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "landing")
    _write(land, "sellers.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,SP\ns2,2,b,SP,more\ns3,3\n")
    _write(land, "unknown.csv", "x\n1\n")
    manifest = sinks.ingest_bronze(spark, land, os.path.join(tmpdir_fresh, "bronze"), fmt="parquet")
    r = manifest.filter("source = 'sellers'").first()
    assert (r.rows, r.corrupt_rows, r.status) == (3, 2, "succeeded")
    assert manifest.filter("file_name = 'unknown.csv'").first().status == "skipped"
    bad = Lake(spark, os.path.join(tmpdir_fresh, "bronze")).read("sellers").filter("_corrupt_record is not null")
    assert {x._corrupt_record for x in bad.collect()} == {"s2,2,b,SP,more", "s3,3"}
