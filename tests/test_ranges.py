"""Quoted, multi-line CSV read by byte ranges."""
import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from marketlake.sources import csv as csv_src
from marketlake.sources.ranges import range_states, read_csv, read_records

PARTS = ["a", "b", ",", '"', '""', "\n", "\r\n", "\r", " ", "é", "日本", "", '",\n', "x" * 40]


def _file(folder, name, rows, line="\r\n", quoting=csv.QUOTE_MINIMAL):
    os.makedirs(folder, exist_ok=True)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line, quoting=quoting)
    writer.writerow(["k", "t", "u"])
    writer.writerows(rows)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(out.getvalue())
    return os.path.join(folder, name)


@pytest.mark.parametrize("range_bytes", [7, 16, 61, 500, 1 << 20])
def test_any_range_size_gives_the_same_records(spark, tmpdir_fresh, range_bytes):
    rng = random.Random(range_bytes)
    rows = [[f"k{i}", "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))), rng.choice(["", "z", "q\nq", 'w"w'])] for i in range(60)]
    path = _file(tmpdir_fresh, "one.csv", rows, rng.choice(["\n", "\r\n"]), csv.QUOTE_ALL)
    frame = read_csv(spark, path, ["k", "t", "u"], {"emptyValue": ""}, range_bytes=range_bytes)
    assert sorted(tuple(x or "" for x in r) for r in frame.collect()) == sorted(map(tuple, rows))
    parts = read_records(spark, path, range_bytes=range_bytes).rdd.getNumPartitions()
    assert parts > 3 or range_bytes >= 500


def test_equal_to_the_library_reader(spark, tmpdir_fresh):
    rng = random.Random(3)
    plain = [p for p in PARTS if "\r" not in p]           # the library turns CRLF inside quotes into LF
    for n in range(3):
        _file(tmpdir_fresh, f"{n}.csv", [[f"k{n}-{i}", "".join(rng.choice(plain) for _ in range(6)), "x"] for i in range(20)], "\n")
    whole = spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').csv(tmpdir_fresh)
    own = read_csv(spark, tmpdir_fresh, ["k", "t", "u"], pattern="*.csv", range_bytes=50)
    assert sorted(map(str, own.collect())) == sorted(map(str, whole.collect()))


def test_a_record_over_many_ranges_and_wrong_fields(spark, tmpdir_fresh):
    long = "line, \"quoted\"\r\n" * 400
    path = _file(tmpdir_fresh, "one.csv", [["1", long, "x"], ["2", "short", "y"], ["3", "more", "z", "extra"], ["4"]])
    got = {r.k: r for r in read_csv(spark, path, ["k", "t", "u"], corrupt="bad", range_bytes=128).collect()}
    assert got["1"].t == long and got["2"].u == "y" and got["1"].bad is None
    assert got["3"].bad == "3,more,z,extra" and got["4"].bad == "4"


def test_a_header_over_two_ranges_empty_files_and_open_quotes(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "h.csv")
    with open(path, "w", newline="") as f:
        f.write('k,"t\nitle",u\n1,2,3\n\n4,5,6\n')
    for size in (4, 9, 100):
        got = read_csv(spark, path, ["k", "t\nitle", "u"], range_bytes=size).collect()
        assert sorted(r.k for r in got) == ["1", "4"]
    with pytest.raises(Exception, match="header is not k,t,u"):
        read_csv(spark, path, ["k", "t", "u"]).collect()
    empty = os.path.join(tmpdir_fresh, "e.csv")
    open(empty, "w").close()
    assert read_csv(spark, empty, ["k", "t", "u"]).count() == 0
    broken = os.path.join(tmpdir_fresh, "b.csv")
    with open(broken, "w") as f:
        f.write('k,t,u\n1,"open,3\n4,5,6\n')
    with pytest.raises(ValueError, match="open quote"):
        read_csv(spark, broken, ["k", "t", "u"])


def test_reviews_are_read_by_ranges(spark, tmpdir_fresh):
    src = csv_src.SOURCES["order_reviews"]
    rows = [[f"r{i}", f"o{i}", "5", "t", f"line one\nline \"two\", {i}", "2017-01-01", "2017-01-02"] for i in range(300)]
    out = io.StringIO()
    csv.writer(out).writerows([list(src.columns), *rows])
    with open(os.path.join(tmpdir_fresh, src.file_name), "w", newline="") as f:
        f.write(out.getvalue())
    frame = csv_src.read_bronze(spark, tmpdir_fresh, "order_reviews", range_bytes=2000)
    assert sorted(map(tuple, frame.drop(csv_src.CORRUPT).collect())) == sorted(map(tuple, rows))
    assert frame.filter(F.col(csv_src.CORRUPT).isNotNull()).count() == 0


def test_compressed_files_are_read_once(spark, tmpdir_fresh, monkeypatch):
    """Files that cannot be split need no states, and no record crosses ranges; an open quote stays an error."""
    import gzip

    from marketlake.sources import ranges
    rows = [[str(i), f'two\r\nlines, "{i}"', "x"] for i in range(30)]
    for n in range(2):
        with open(_file(tmpdir_fresh, f"{n}.csv", rows), "rb") as plain, gzip.open(f"{tmpdir_fresh}/{n}.csv.gz", "wb") as packed:
            packed.write(plain.read())
    with gzip.open(os.path.join(tmpdir_fresh, "broken.gz"), "wt") as f:
        f.write('k,t,u\n1,"open,3\n4,5,6\n')
    monkeypatch.setattr(ranges, "range_states", None)
    got = read_csv(spark, tmpdir_fresh, ["k", "t", "u"], pattern="*.csv.gz", range_bytes=64)
    assert sorted(tuple(r) for r in got.collect()) == sorted([tuple(r) for r in rows] * 2)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="open quote"):
        read_csv(spark, os.path.join(tmpdir_fresh, "broken.gz"), ["k", "t", "u"]).collect()


def test_records_are_grouped_only_if_some_cross_ranges(spark, tmpdir_fresh):
    path = _file(tmpdir_fresh, "one.csv", [["1", "a\nb", "x"]])
    assert "Aggregate" not in read_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in read_records(spark, path, range_bytes=9)._jdf.queryExecution().optimizedPlan().toString()
