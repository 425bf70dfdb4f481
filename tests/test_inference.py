"""Types inferred over all rows, without loss."""
import datetime

import pytest

from marketlake.sources.inference import infer_types, read_inferred

CASES = {
    "boolean": ["true", "FALSE", None], "int": ["0", "-7", "2147483647"], "long": ["1", "2147483648"],
    "double": ["1", "-2.50", "1e3"], "timestamp": ["2018-01-02", "2018-01-02 03:04:05", "2018-01-02 03:04:05.123"],
    "void": [None, None], "string": ["a", "1"],
}
STRINGS = [["01037", "1"], ["9223372036854775808"], ["1", "true"], ["1", "2018-01-02"], [" 1"], ["NaN"], ["1e999"], ["2018-02-30"], [""], ["-01"],
           ["1."], ["+1"], ["2018-01-02 25:00:00"], ["1\n"], ["é"]]


def _infer(spark, values):
    return infer_types({"s": spark.createDataFrame([(v,) for v in values], "v string")}).first()


@pytest.mark.parametrize("kind", CASES)
def test_each_type(spark, kind):
    got = _infer(spark, CASES[kind])
    assert (got.inferred_type, got.filled) == (kind, sum(v is not None for v in CASES[kind]))


def test_values_that_only_a_string_holds(spark):
    rows = [(i, v) for i, values in enumerate(STRINGS) for v in values]
    frames = {str(i): spark.createDataFrame([(v,) for v in values], "v string") for i, values in enumerate(STRINGS)}
    got = {r.source: r.inferred_type for r in infer_types(frames).collect()}
    assert got == {str(i): "string" for i, _ in rows}
    assert _infer(spark, ["01037", "0", "-01"]).leading_zeros == 2


def test_typed_frame_keeps_every_value(spark):
    df = spark.createDataFrame([("01037", "5", "1.5", "2018-01-02 03:04:05", None), ("2", None, "2", "2018-01-03", None)],
                               "zip string, n string, x string, at string, none string")
    got = read_inferred(df)
    assert dict(got.dtypes) == {"zip": "string", "n": "int", "x": "double", "at": "timestamp_ntz", "none": "string"}
    assert got.first() == ("01037", 5, 1.5, datetime.datetime(2018, 1, 2, 3, 4, 5), None)
    empty = df.limit(0)
    assert {r.inferred_type for r in infer_types({"e": empty}).collect()} == {"void"}


def test_all_columns_from_one_aggregate(spark):
    """One row a column of each frame, columns without rows too, from one exchange; leading zeros counted, short cuts exact."""
    values = spark.createDataFrame([("007", "-0", "TRUE", "2020-01-02"), ("-01", "12", "false", None)], "a string, b string, c string, d string")
    numbers = spark.createDataFrame([("1.5e-3", "-9223372036854775808"), ("7", "2147483648")], "f string, g string")
    empty = spark.createDataFrame([], "e string")
    out = infer_types({"full": values, "numbers": numbers, "empty": empty})
    rows = {(r.source, r.position, r.column_name): (r.inferred_type, r.filled, r.leading_zeros) for r in out.collect()}
    assert rows == {("full", 0, "a"): ("string", 2, 2), ("full", 1, "b"): ("int", 2, 0), ("full", 2, "c"): ("boolean", 2, 0),
                    ("full", 3, "d"): ("timestamp", 1, 0), ("numbers", 0, "f"): ("double", 2, 0),
                    ("numbers", 1, "g"): ("long", 2, 0), ("empty", 0, "e"): ("void", 0, 0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
