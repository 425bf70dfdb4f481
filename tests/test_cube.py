"""The scenario cube answers what the lines answer."""
import itertools

import pytest

from marketlake.plans import cube, scenario
from marketlake.plans.registry import models

from conftest import SF_SMOKE

STATES = ["SP", "RJ", "MG", "BA"]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube") / "lines")
    models(spark, SF_SMOKE)["gold_executive_overview"].write.parquet(path)
    return spark.read.parquet(path)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_answers_equal_the_direct_queries(spark, lines):
    cells = cube.scenario_cube(lines)
    many = cube.selected(cells, STATES, (5, 30))
    kpis = {(r.selection, r.max_days): r for r in cube.kpis(many, "selection", "max_days").collect()}
    bins = cube.lead_times(many, "selection", "max_days").collect()
    load = cube.hub_load(many, "selection", "max_days").collect()
    for mask, days in itertools.product((0, 1, 6, 9, 15), (5, 30)):
        chosen = [s for k, s in enumerate(STATES) if mask >> k & 1] or None
        direct = scenario.scenario_filter(lines, chosen, days)
        own = scenario.scenario_filter(cells, chosen, days)      # the same filter takes cells
        want = scenario.scenario_kpis(direct).first().asDict()
        assert cube.kpis(own).first().asDict() == want
        row = kpis[mask, days].asDict()
        assert {k: row[k] for k in want} == want
        histogram = scenario.lead_time_histogram(direct)
        assert _rows(cube.lead_times(own)) == _rows(histogram)
        assert sorted(tuple(r)[2:] for r in bins if (r.selection, r.max_days) == (mask, days)) == sorted(map(tuple, histogram.collect()))
        hubs = scenario.hub_load(direct)
        assert _rows(cube.hub_load(own)) == _rows(hubs)
        assert sorted(tuple(r)[2:] for r in load if (r.selection, r.max_days) == (mask, days)) == sorted(map(tuple, hubs.collect()))


def test_cubes_of_parts_add_up(lines):
    parts = [cube.scenario_cube(lines.where(f"pmod(hash(order_key), 3) = {k}")) for k in range(3)]
    whole, again = cube.scenario_cube(lines), cube.merged(parts)
    assert _rows(whole) == _rows(again.select(*whole.columns))


def test_lines_without_a_state_and_empty_cubes(spark, lines):
    some = lines.where("customer_state = 'SP'").limit(3).withColumn("customer_state", lines["customer_state"].substr(9, 0))
    nulls = some.selectExpr("*", "cast(null as string) as s").drop("customer_state").withColumnRenamed("s", "customer_state")
    cells = cube.selected(cube.scenario_cube(nulls), ["SP"], (1000,))
    assert {r.selection for r in cells.collect()} == {0}
    empty = cube.scenario_cube(lines.limit(0))
    assert cube.kpis(empty).first().asDict() == scenario.scenario_kpis(lines.limit(0)).first().asDict()
    assert {r.orders_handled for r in cube.hub_load(empty).collect()} == {0}
