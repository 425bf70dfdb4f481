"""Named queries over the driver test tables: (spark, sf_dir) -> DataFrame.

Each query derives the bronze frames from the given tables (see
`sources.testdata`), builds only the models it needs and returns a lazy
DataFrame over the whole input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.expressions import STATE_BY_NATION, amount_sum, exact_avg, in_units, round_money_sum
from marketlake.operators import bitmaps
from marketlake.operators.digests import compare_tables
from marketlake.plans import core, cube, gold, quality, scenario
from marketlake.plans.build import Models, publish, run_pipeline
from marketlake.plans.staging import build_staging
from marketlake.session import checkpoint_dir, configure
from marketlake.sources.catalog import SOURCES
from marketlake.sources.csv import CORRUPT, read_bronze_all
from marketlake.sources.inference import infer_types
from marketlake.sources.lake import Lake
from marketlake.sources.ledger import land_changed
from marketlake.sources.ranges import read_csv
from marketlake.sources.sinks import ingest_bronze, read_bronze_tables, register_views
from marketlake.sources.testdata import bronze_from_testdata

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed value: rows of the route sample.
ROUTE_SAMPLE = 3000


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(bronze_from_testdata(spark, sf_dir))


def _model(name: str) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir)[name]


def try_cast_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review values that fail to parse: the raw text next to its null parse."""
    raw = bronze_from_testdata(spark, sf_dir)["order_reviews"]
    score = F.col("review_score").try_cast("int")
    answer = F.col("review_answer_timestamp").try_cast("timestamp_ntz")
    return raw.select(
        F.col("review_id").alias("review_key"),
        F.col("review_score").alias("raw_review_score"), score.alias("review_score"),
        F.col("review_answer_timestamp").alias("raw_answer_timestamp"), answer.alias("answer_timestamp"),
    ).filter((F.col("raw_review_score").isNotNull() & F.col("review_score").isNull())
             | (F.col("raw_answer_timestamp").isNotNull() & F.col("answer_timestamp").isNull()))


def delivery_status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, value and average delivery days per delivery status."""
    orders = models(spark, sf_dir)["fct_orders"]
    return orders.groupBy("delivery_performance_status").agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_money_sum("total_order_value").alias("total_order_value"),
        exact_avg("actual_delivery_days", 1).alias("avg_actual_delivery_days"))


def scaled_money_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact totals of order values a million times as large, in millionths: far beyond what a long holds."""
    orders = models(spark, sf_dir)["fct_orders"]
    return orders.groupBy("delivery_performance_status").agg(
        F.count(F.lit(1)).alias("total_orders"),
        in_units(amount_sum(F.col("total_order_value") * F.lit(1e6))).cast("string").alias("total_millionths"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return quality.run_checks({name: m[name] for name in m})


def quality_at_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report that a whole build publishes beside its tables: checks of single rows counted by the writes."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-build-{uuid.uuid4().hex}"
    return run_pipeline(spark, bronze_from_testdata(spark, sf_dir), root, fmt="parquet", gate=False)["quality_report"]


def optimizer_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.optimizer_violations(models(spark, sf_dir)["gold_executive_overview"])


def _landing_texts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The bronze frames as their landing files hold them."""
    bronze = bronze_from_testdata(spark, sf_dir)
    return {n: bronze[n].select(*[F.col(c).cast("string").alias(c) for c in s.columns]) for n, s in SOURCES.items()}


#: Most rows of a landing file: files are compressed, so each is read by one task.
LANDING_ROWS = 200_000


def _write_landing(texts: dict[str, DataFrame], landing: str, mode: str = "errorifexists") -> None:
    """Write the frames as folders of gzip-compressed landing files."""
    def write(item):
        name, rows = item
        (rows.write.mode(mode).option("header", "true").option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", LANDING_ROWS)
         .csv(f"{landing}/{SOURCES[name].file_name}"))

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, texts.items()))


def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing round trip: rows landed from each source, and how many differ.

    The derived bronze frames are written as landing CSV files (under the shared
    checkpoint root) and ingested through the CSV readers.  The result compares the ingested
    tables with their sources by bucketed digests of whole rows (`operators.digests`): rows missing and rows that
    should not be there.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-landing-{uuid.uuid4().hex}"
    texts = _landing_texts(spark, sf_dir)
    _write_landing(texts, f"{root}/landing")
    # Spark writes a folder of part files per source; the readers take folders.
    ingest_bronze(spark, f"{root}/landing", f"{root}/bronze", fmt="parquet")
    bronze_tables = read_bronze_tables(spark, f"{root}/bronze", "parquet")
    pairs = {name: (bronze_tables[name], texts[name], list(src.columns)) for name, src in SOURCES.items()}
    return compare_tables(pairs).withColumnRenamed("name", "source")


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of every column of the nine sources, inferred over their whole landing files."""
    landing = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-inference-{uuid.uuid4().hex}"
    _write_landing(_landing_texts(spark, sf_dir), landing)
    return infer_types({name: df.drop(CORRUPT) for name, df in read_bronze_all(spark, landing).items()})


def landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings with a ledger: all sources, then after the sellers' files were replaced and the payments got further files.

    One row a source: what the second landing did to its files, rows before and after, and how the landed rows differ
    from those that the folder then holds.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-ledger-{uuid.uuid4().hex}"
    texts = _landing_texts(spark, sf_dir)
    landing, bronze_dir = f"{root}/landing", f"{root}/bronze"
    _write_landing(texts, landing)
    first = land_changed(spark, landing, bronze_dir, fmt="parquet")
    moved = texts["sellers"].withColumn("seller_city", F.concat(F.lit("new "), "seller_city"))
    _write_landing({"sellers": moved}, landing, "overwrite")
    _write_landing({"order_payments": texts["order_payments"]}, landing, "append")
    second = land_changed(spark, landing, bronze_dir, fmt="parquet")
    held = {**texts, "sellers": moved, "order_payments": texts["order_payments"].unionAll(texts["order_payments"])}
    landed = read_bronze_tables(spark, bronze_dir, "parquet")
    differing = compare_tables({name: (landed[name], held[name], list(src.columns)) for name, src in SOURCES.items()})
    before = first.groupBy("source").agg(F.sum("rows").alias("rows_before"))
    states = second.groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("state")), ",").alias("file_states"))
    return (differing.withColumnRenamed("name", "source").join(before, "source").join(states, "source")
            .select("source", "file_states", "rows_before", "rows", "rows_missing", "rows_extra"))


#: Split size of `csv_by_ranges`: small enough that the smallest tables have several ranges a file.
RANGE_BYTES = 1 << 20


def csv_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as quoted, multi-line CSV files and read back by byte ranges, many to a file."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-ranges-{uuid.uuid4().hex}"
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    (spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
     .write.option("header", "true").option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder))
    rows = read_csv(spark, folder, columns, pattern="*.csv", range_bytes=RANGE_BYTES)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.col("n_chars").cast("long").alias("n_chars"),
                       F.char_length("text").cast("long").alias("read_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def atomic_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after four builds of one folder: the first, one that fails in a task of its last layer, one whose
    check fails, and one that succeeds.  All but the first have doubled amounts.

    One row a build and table: the commit that readers got, and rows and total amount of the table as of then.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-refresh-{uuid.uuid4().hex}"
    bronze = bronze_from_testdata(spark, sf_dir)

    def layers(factor: int, broken_task: bool = False, broken_check: bool = False) -> list:
        def staging(_):
            stg = build_staging({n: bronze[n] for n in SOURCES})
            items = stg["stg_order_items"].withColumns({c: F.col(c) * factor for c in ("price", "freight_value")})
            return {"stg_orders": stg["stg_orders"], "stg_order_items": items, "stg_order_payments": stg["stg_order_payments"]}

        def facts(t):
            orders = core.fct_orders(t["stg_orders"], t["stg_order_items"])
            return {"fct_orders": orders.unionByName(orders) if broken_check else orders,
                    "fct_order_payments": core.fct_order_payments(t["stg_order_payments"])}

        def marts(t):
            mart = gold.payment_analysis(t["fct_order_payments"], t["fct_orders"])
            poison = F.when(F.col("payment_type").isNotNull(), F.raise_error(F.lit("planted"))).otherwise(F.col("payment_type"))
            return {"gold_payment_analysis": mart.withColumn("payment_type", poison) if broken_task else mart}
        return [staging, facts, marts]

    parts = []
    for step, options in (("built", {"factor": 1}), ("task failed", {"factor": 2, "broken_task": True}),
                          ("check failed", {"factor": 2, "broken_check": True}), ("repeated", {"factor": 2})):
        try:
            publish(spark, layers(**options), root, "parquet")
        except Exception as exc:  # noqa: BLE001 - the planted failures; any other is raised
            if not ("planted" in str(exc) and step == "task failed" or isinstance(exc, quality.QualityError) and step == "check failed"):
                raise
        lake = Lake(spark, root)
        seen = lake.commit()
        for name, amounts in (("stg_order_items", "price"), ("fct_orders", "total_order_value"),
                              ("gold_payment_analysis", "total_associated_order_gmv")):
            parts.append(lake.read(name, seen).agg(F.count(F.lit(1)).alias("rows"), round_money_sum(amounts).alias("total")).select(
                F.lit(step).alias("step"), F.lit(seen.number).cast("long").alias("commit"), F.lit(name).alias("table_name"), "rows", "total"))
    return reduce(DataFrame.unionByName, parts)


def mart_by_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What hubs save by state, asked in SQL of a mart exposed as a view."""
    session = spark.newSession()      # its views are its own
    configure(session)
    register_views({"gold_executive_overview": models(session, sf_dir)["gold_executive_overview"]})
    return session.sql("""
        SELECT customer_state, count(*) AS faster_lines, count(DISTINCT order_key) AS faster_orders,
               max(actual_shipping_days - optimized_shipping_days) AS most_days_saved
        FROM gold_executive_overview WHERE optimized_shipping_days < actual_shipping_days GROUP BY customer_state""")


def _scenario(fn: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(models(spark, sf_dir))


def _filtered(m: Models) -> DataFrame:
    return scenario.scenario_filter(m["gold_executive_overview"])


def _routes(m: Models) -> DataFrame:
    return scenario.filter_routes(m["gold_spatial_routing"])


#: Longest times for which the cube queries answer every selection of states.
CUBE_DAYS = (10, 20, 30)


def _cube_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of every selection of the eight states, from a written cube: the lines are read once."""
    place = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-cube-{uuid.uuid4().hex}"
    cube.scenario_cube(models(spark, sf_dir)["gold_executive_overview"]).write.parquet(place)
    return cube.selected(spark.read.parquet(place), STATE_BY_NATION, CUBE_DAYS)


def cube_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline numbers of all 2^8 selections of states and three longest times, from the cube."""
    return cube.kpis(_cube_cells(spark, sf_dir), "selection", "max_days")


def cube_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead-time histograms of the same selections, from the cube."""
    return cube.lead_times(_cube_cells(spark, sf_dir), "selection", "max_days")


def cube_hub_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub load of the same selections, from the cube."""
    return cube.hub_load(_cube_cells(spark, sf_dir), "selection", "max_days").select(
        "selection", "max_days", "hub_name", "capacity", "orders_handled")


def _corridor_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin_state, destination_state, bucket, bitmap) of the orders shipped on each corridor, written once."""
    m = models(spark, sf_dir)
    corridors = (m["fct_order_items"].select("order_key", "seller_key", "customer_key")
                 .join(m["dim_sellers"].select("seller_key", F.col("state").alias("origin_state")), "seller_key")
                 .join(m["dim_customers"].select("customer_key", F.col("state").alias("destination_state")), "customer_key")
                 .where("origin_state is not null and destination_state is not null"))
    table = bitmaps.bitmap_table(corridors, CORRIDOR, "order_key", bitmaps.numbered(m["fct_orders"], "order_key"))
    return _written(spark, table)


def _written(spark: SparkSession, table: DataFrame) -> DataFrame:
    place = f"{checkpoint_dir(spark).rstrip('/')}/marketlake-bitmaps-{uuid.uuid4().hex}"
    table.write.parquet(place)
    return spark.read.parquet(place)


CORRIDOR = ["origin_state", "destination_state"]


def corridor_order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders by corridor, origin, destination and in all, from one bitmap table."""
    return bitmaps.rollups(_corridor_bitmaps(spark, sf_dir), [CORRIDOR, CORRIDOR[:1], CORRIDOR[1:], []], CORRIDOR, "total_orders")


def origin_set_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders with a line from any of the chosen origin states, for all 2^8 - 1 choices: bitmaps joined, no facts read again."""
    table = _corridor_bitmaps(spark, sf_dir)
    states = F.array_position(F.array(*[F.lit(s) for s in STATE_BY_NATION]), F.col("origin_state"))
    chosen = F.filter(F.sequence(F.lit(1), F.lit((1 << len(STATE_BY_NATION)) - 1)),
                      lambda mask: F.getbit(mask, (states - 1).cast("int")) == 1)
    merged = table.groupBy("origin_state", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return bitmaps.distinct_counts(merged.withColumn("selection", F.explode(chosen)), ["selection"], "total_orders")


def buyer_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct buyers by month, quarter and year and in all, from one bitmap table of months."""
    m = models(spark, sf_dir)
    bought = (m["fct_orders"].select("customer_key", F.to_date("purchased_at").alias("date_key"))
              .join(m["dim_customers"].select("customer_key", "customer_unique_id"), "customer_key")
              .join(m["dim_dates"].select("date_key", "calendar_year", "quarter_year", "calendar_month"), "date_key"))
    columns = ["calendar_year", "quarter_year", "calendar_month"]
    table = bitmaps.bitmap_table(bought, columns, "customer_unique_id", bitmaps.numbered(m["dim_customers"], "customer_unique_id"))
    return bitmaps.rollups(_written(spark, table), [columns, columns[:2], columns[:1], []], columns, "total_unique_buyers")


def spatial_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route sample: its 3,000 rows are the feature (O1); the written table has every route."""
    m = models(spark, sf_dir)
    return gold.spatial_routing(m["fct_order_items"], m["dim_sellers"], m["dim_customers"], n=ROUTE_SAMPLE)


def fixed_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the source's own years, with the orders bought on each day."""
    days = core.dim_dates(core.fixed_bounds(spark))
    bought = models(spark, sf_dir)["stg_orders"].groupBy(F.to_date("purchase_timestamp").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders"))
    return days.join(bought, "date_key", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def default_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline numbers of the default selection, the first five states."""
    executive = models(spark, sf_dir)["gold_executive_overview"]
    # a limit of five rows
    chosen = F.broadcast(scenario.default_states(executive))
    return scenario.scenario_kpis(scenario.scenario_filter(executive).join(chosen, "customer_state", "left_semi"))


def planted_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invariant over a projection with known bad rows: some orders slower than before, some below zero."""
    executive = models(spark, sf_dir)["gold_executive_overview"]
    key = F.col("order_key").cast("long")
    bad = executive.withColumns({
        "optimized_shipping_days": F.when(key % 11 == 0, F.col("actual_shipping_days") + 1)
        .when(key % 13 == 0, -1).otherwise(F.col("optimized_shipping_days")),
        "optimized_freight": F.when(key % 17 == 0, -0.5).otherwise(F.col("optimized_freight"))})
    return quality.optimizer_violations(bad)


QUERIES: dict[str, Query] = {
    # staging
    "stg_customers": _model("stg_customers"),
    "stg_orders": _model("stg_orders"),
    "stg_order_items": _model("stg_order_items"),
    "stg_order_payments": _model("stg_order_payments"),
    "stg_products": _model("stg_products"),
    "geo_representative_point": _model("stg_geolocation"),
    "keep_latest_review": _model("stg_order_reviews"),
    "dedup_seller": _model("stg_sellers"),
    "dedup_category": _model("stg_category_translation"),
    "try_cast_parse": try_cast_parse,
    # core
    "dim_customers_geo": _model("dim_customers"),
    "dim_sellers_geo": _model("dim_sellers"),
    "dim_products_category": _model("dim_products"),
    "dim_dates_calendar": _model("dim_dates"),
    "dim_dates_fixed": fixed_calendar,
    "fct_order_items": _model("fct_order_items"),
    "fct_order_payments": _model("fct_order_payments"),
    "fct_order_reviews": _model("fct_order_reviews"),
    "fct_orders": _model("fct_orders"),
    "seller_performance": _model("int_seller_performance"),
    "delivery_status_summary": delivery_status_summary,
    "scaled_money_totals": scaled_money_totals,
    # gold
    "category_performance": _model("gold_category_performance"),
    "customer_cohorts": _model("gold_customer_cohorts"),
    "executive_overview": _model("gold_executive_overview"),
    "payment_analysis": _model("gold_payment_analysis"),
    "regional_logistics": _model("gold_regional_logistics"),
    "review_text_signals": _model("gold_review_text_signals"),
    "seller_scorecard": _model("gold_seller_scorecard"),
    "spatial_routing": spatial_routing,
    "spatial_routes_all": _model("gold_spatial_routing"),
    # scenario analytics
    "state_list": _scenario(lambda m: scenario.state_list(m["gold_executive_overview"])),
    "scenario_kpis_default": default_scenario,
    "scenario_kpis": _scenario(lambda m: scenario.scenario_kpis(_filtered(m))),
    "lead_time_histogram": _scenario(lambda m: scenario.lead_time_histogram(_filtered(m))),
    "hub_load": _scenario(lambda m: scenario.hub_load(_filtered(m))),
    "corridor_order_rollup": corridor_order_rollup,
    "origin_set_orders": origin_set_orders,
    "buyer_rollup": buyer_rollup,
    "cube_kpis": cube_kpis,
    "cube_histogram": cube_histogram,
    "cube_hub_load": cube_hub_load,
    "corridor_top_k": _scenario(lambda m: scenario.corridor_top_k(_filtered(m), _routes(m))),
    "route_centroid": _scenario(lambda m: scenario.route_centroid(_routes(m))),
    "route_legs": _scenario(lambda m: scenario.route_legs(_routes(m))),
    "corridor_display": _scenario(
        lambda m: scenario.corridor_display(scenario.corridor_top_k(_filtered(m), _routes(m)))),
    # sources and sinks
    "bronze_manifest": bronze_manifest,
    "inferred_types": inferred_types,
    "landing_ledger": landing_ledger,
    "mart_by_view": mart_by_view,
    "csv_by_ranges": csv_by_ranges,
    "atomic_refresh": atomic_refresh,
    # data quality
    "quality_report": quality_report,
    "quality_at_write": quality_at_write,
    "optimizer_violations": optimizer_violations,
    "optimizer_violations_planted": planted_violations,
}
