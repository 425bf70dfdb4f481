"""Incremental landing lands each file exactly once across runs."""
import os

from marketlake.streaming import land_new_files


def test_land_new_files_is_incremental(spark, tmpdir_fresh):
    land, bronze = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "bronze")
    os.makedirs(land)
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    with open(os.path.join(land, "part1-sellers.csv"), "w") as f:
        f.write(header + "s1,01001,sao paulo,SP\ns2,20000,rio,RJ\n")
    assert land_new_files(spark, land, bronze, "sellers") == 2
    assert land_new_files(spark, land, bronze, "sellers") == 0          # nothing new
    with open(os.path.join(land, "part2-sellers.csv"), "w") as f:
        f.write(header + "s3,30000,bh,MG\n")
    assert land_new_files(spark, land, bronze, "sellers") == 1
    landed = spark.read.parquet(os.path.join(bronze, "sellers"))
    assert landed.count() == 3
    assert {r._source_file for r in landed.collect()} == {"part1-sellers.csv", "part2-sellers.csv"}
    assert landed.filter("seller_id = 's1'").first().seller_zip_code_prefix == "01001"


def test_land_multiline_reviews(spark, tmpdir_fresh):
    land, bronze = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "bronze")
    os.makedirs(land)
    with open(os.path.join(land, "batch1-order_reviews.csv"), "w") as f:
        f.write('review_id,order_id,review_score,review_comment_title,review_comment_message,'
                'review_creation_date,review_answer_timestamp\n'
                'r1,o1,5,,"linha um\nlinha ""dois""",2018-01-18 00:00:00,2018-01-19 00:00:00\n'
                'r2,o2,1,,,2018-01-20 00:00:00,\n')
    assert land_new_files(spark, land, bronze, "order_reviews") == 2
    row = spark.read.parquet(os.path.join(bronze, "order_reviews")).filter("review_id = 'r1'").first()
    assert row.review_comment_message == 'linha um\nlinha "dois"'


def test_cli_land_with_file_pattern(spark, tmpdir_fresh):
    from marketlake.__main__ import main
    land, bronze = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "bronze")
    os.makedirs(land)
    with open(os.path.join(land, "vendors-2018.csv"), "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9,09000,santo andre,SP\n")
    assert main(["land", "--landing", land, "--bronze", bronze, "--file", "sellers=vendors-*.csv"]) == 0
    assert spark.read.parquet(os.path.join(bronze, "sellers")).count() == 1


def _land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_rows_are_counted_beyond_the_kept_updates(spark, tmpdir_fresh):
    land, bronze = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "bronze")
    for i in range(6):
        _land(land, f"{i}-sellers.csv", HEADER + f"s{i},1,a,SP\n")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        assert land_new_files(spark, land, bronze, "sellers", max_files_per_trigger=1) == 6
    finally:
        spark.conf.unset(key)
    assert os.path.isdir(os.path.join(bronze, "_landing", "sellers"))    # progress beside the table


def test_ingest_and_land_do_not_share_a_folder(spark, tmpdir_fresh):
    import pytest

    from marketlake.sources.sinks import ingest_bronze
    land, bronze = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "bronze")
    _land(land, "sellers.csv", HEADER + "s1,1,a,SP\n")
    assert land_new_files(spark, land, bronze, "sellers") == 1
    row = ingest_bronze(spark, land, bronze, fmt="parquet").filter("source = 'sellers'").first()
    assert row.status == "failed" and "incremental" in row.error
    assert spark.read.parquet(os.path.join(bronze, "sellers")).count() == 1
    other = os.path.join(tmpdir_fresh, "other")
    assert ingest_bronze(spark, land, other, fmt="parquet").filter("source = 'sellers'").first().status == "succeeded"
    with pytest.raises(ValueError, match="full ingest"):
        land_new_files(spark, land, other, "sellers")
