"""Scenario analytics over a small what-if frame."""
from marketlake.plans import scenario


def _exec(spark):
    rows = [("o1", "SP", 10, 7, 3, 10.0, 6.5, 3.5, 0), ("o2", "RJ", 25, 16, 9, 20.0, 13.0, 7.0, 1),
            ("o3", "MG", 40, 26, 14, 5.0, 3.25, 1.75, 0), ("o4", None, 2, 1, 1, 1.0, 0.65, 0.35, 0),
            ("o5", "BA", 50, 33, 17, 1.0, 0.65, 0.35, 1)]
    return spark.createDataFrame(rows, "order_key string, customer_state string, actual_shipping_days int, "
                                       "optimized_shipping_days int, days_saved int, actual_freight double, "
                                       "optimized_freight double, freight_dollars_saved double, is_optimized_late int")


def test_default_states_and_filter(spark):
    ex = _exec(spark)
    assert [r.customer_state for r in scenario.default_states(ex, 2).collect()] == ["BA", "MG"]
    got = {r.order_key for r in scenario.scenario_filter(ex, states=["SP", "RJ", "BA"], max_days=30).collect()}
    assert got == {"o1", "o2"}                                     # o5 exceeds max days
    flags = {r.customer_state: r.is_default for r in scenario.state_list(ex, 2).collect()}
    assert flags == {"BA": True, "MG": True, "RJ": False, "SP": False}


def test_kpis(spark):
    r = scenario.scenario_kpis(_exec(spark).filter("order_key in ('o1','o2')")).first()
    assert (r.total_baseline_freight, r.total_optimized_freight, r.freight_savings) == (30.0, 19.5, 10.5)
    assert r.freight_savings_pct == 35.0 and r.avg_days_saved == 6.0
    assert (r.baseline_on_time, r.optimized_on_time, r.otif_lift_pct) == (1, 1, 0.0)


def test_histogram_bins(spark):
    rows = {(r.series, r.bin_index): r.n for r in scenario.lead_time_histogram(_exec(spark)).collect()}
    assert rows[("baseline", 6)] == 1                              # 10 days -> [9, 10.5)
    assert rows[("baseline", 26)] == 1                             # 40 days -> last bin [39, 40.5)
    assert rows[("baseline", 27)] == 1                             # 50 days: the row beyond the last edge
    assert sum(n for (series, _), n in rows.items() if series == "baseline") == 5
    assert rows[("optimized", 0)] == 1                             # 1 day


def test_hub_load_null_state_goes_to_sao_paulo(spark):
    out = {r.hub_name: r.orders_handled for r in scenario.hub_load(_exec(spark)).collect()}
    assert out == {"Sao Paulo Hub": 3, "Rio de Janeiro Hub": 1, "Belo Horizonte Hub": 1}


def test_corridor_top_k_and_centroid(spark):
    ex = _exec(spark)
    routes = spark.createDataFrame(
        [("o1", "SP", "c", "x", -23.0, -46.0), ("o2", "SP", "c", "x", -22.0, -43.0), ("o2", "MG", "c", "x", -22.0, -43.0)],
        "order_key string, seller_state string, seller_city string, customer_city string, customer_lat double, customer_lon double")
    top = scenario.corridor_top_k(ex, routes, k=2).collect()
    assert [(r.seller_state, r.customer_state) for r in top] == [("MG", "RJ"), ("SP", "RJ")]
    assert top[0].freight_pct == 35.0
    c = scenario.route_centroid(routes, selected_states=5).first()
    assert (c.center_lat, c.center_lon) == (-22.333333, -44.0)
    e = scenario.route_centroid(routes.filter("false"), selected_states=5).first()
    assert (e.center_lat, e.center_lon, e.n_routes) == (-22.5, -45.0, 0)


def test_corridor_match_by_seller(spark):
    ex = spark.createDataFrame(
        [("o1", "s_sp", "RJ", 5, 2.0, 1.0), ("o1", "s_mg", "RJ", 1, 4.0, 2.0)],
        "order_key string, seller_key string, customer_state string, days_saved int, "
        "actual_freight double, freight_dollars_saved double")
    routes = spark.createDataFrame([("o1", "s_sp", "SP"), ("o1", "s_mg", "MG")],
                                   "order_key string, seller_key string, seller_state string")
    by_order = {(r.seller_state, r.customer_state): r for r in scenario.corridor_top_k(ex, routes).collect()}
    assert by_order[("SP", "RJ")].avg_days_saved == 3.0             # both lines mixed into each corridor
    by_seller = {(r.seller_state, r.customer_state): r
                 for r in scenario.corridor_top_k(ex, routes, match_seller=True).collect()}
    assert by_seller[("SP", "RJ")].avg_days_saved == 5.0 and by_seller[("MG", "RJ")].avg_days_saved == 1.0
    assert by_seller[("MG", "RJ")].freight_pct == 50.0


def test_corridor_rewrite_equals_direct_merge(spark):
    """Per-order pre-aggregation weighted by counts == merge every line with
    every route of its order, then group (the source's formulation)."""
    import duckdb
    ex_rows = [("o1", "RJ", 5, 10.0, 3.5), ("o1", "RJ", 1, 2.0, 0.7), ("o2", "SP", 2, 4.0, 1.4),
               ("o3", None, 3, 1.0, 0.35), ("o4", "MG", None, 8.0, 2.8), ("o5", "SP", 7, 3.0, 1.05)]
    rt_rows = [("o1", "SP"), ("o1", "SP"), ("o1", "MG"), ("o2", "SP"), ("o3", "SP"), ("o4", None),
               ("o4", "RJ"), ("o5", "SP"), ("o6", "SP")]
    ex = spark.createDataFrame(ex_rows, "order_key string, customer_state string, days_saved int, "
                                        "actual_freight double, freight_dollars_saved double")
    routes = spark.createDataFrame(rt_rows, "order_key string, seller_state string")
    cols = ["seller_state", "customer_state", "total_orders", "avg_days_saved", "total_freight_saved", "freight_pct"]
    got = [tuple(r[c] for c in cols) for r in scenario.corridor_top_k(ex, routes, k=10).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE e (order_key VARCHAR, customer_state VARCHAR, days_saved INT, "
                "actual_freight DOUBLE, freight_dollars_saved DOUBLE)")
    con.executemany("INSERT INTO e VALUES (?, ?, ?, ?, ?)", ex_rows)
    con.execute("CREATE TABLE r (order_key VARCHAR, seller_state VARCHAR)")
    con.executemany("INSERT INTO r VALUES (?, ?)", rt_rows)
    want = con.execute("""
      SELECT seller_state, customer_state, n,
        round_even(avg_days::VARCHAR::DECIMAL(38,15), 1)::DOUBLE,
        round_even(saved::VARCHAR::DECIMAL(38,15), 2)::DOUBLE,
        round_even((saved / actual * 100)::VARCHAR::DECIMAL(38,15), 1)::DOUBLE
      FROM (SELECT r.seller_state, e.customer_state, count(DISTINCT e.order_key) AS n,
              avg(e.days_saved) AS avg_days,
              sum(e.freight_dollars_saved::DECIMAL(18,2))::DOUBLE AS saved,
              sum(e.actual_freight::DECIMAL(18,2))::DOUBLE AS actual
            FROM e JOIN r ON e.order_key = r.order_key
            WHERE r.seller_state IS NOT NULL AND e.customer_state IS NOT NULL GROUP BY 1, 2)
      ORDER BY n DESC, seller_state, customer_state""").fetchall()
    assert got == want


def test_zoom_counts_the_states_of_the_routes(spark):
    one = spark.createDataFrame([("SP", -23.0, -46.0)], "customer_state string, customer_lat double, customer_lon double")
    assert scenario.route_centroid(one).first().zoom == 6
    four = spark.createDataFrame([(s, -23.0, -46.0) for s in ("SP", "RJ", "MG", "BA")], "customer_state string, customer_lat double, customer_lon double")
    assert scenario.route_centroid(four).first().zoom == 5


def test_no_selection_means_all_states(spark):
    ex = spark.createDataFrame([(f"S{i}", 3) for i in range(9)], "customer_state string, optimized_shipping_days int")
    assert scenario.scenario_filter(ex).count() == 9
    assert [r[0] for r in scenario.default_states(ex).collect()] == ["S0", "S1", "S2", "S3", "S4"]
