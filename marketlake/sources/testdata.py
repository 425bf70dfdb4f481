"""Adapter: driver test tables -> the nine bronze (all-string) landing frames.

The driver ships TPC-H-shaped parquet tables, not marketplace CSVs.  This
module derives marketplace-shaped bronze frames from them with deterministic
rules (key arithmetic only), so every downstream model runs unchanged and its
work grows with the input tables.

Keys are strings, as in the landing files, and the review source stays raw
text (its parser must meet unparsable values).  Other values are emitted
already typed (timestamps, two-decimal amounts, counts) where the text round
trip of a CSV would be lossless: staging's casts are then no-ops and the
benchmark measures model work rather than number formatting.  The CSV reader
path is exercised separately by the file sources and their tests.

Rules (the DuckDB oracle implements the same rules independently):

* orders: order_id = o_orderkey (k), customer_id = o_custkey; status F ->
  delivered, O -> shipped, P -> canceled when k%10=0 else delivered;
  purchase = o_orderdate; approved = purchase + k%2 days; handed to carrier =
  purchase + (1 + k%3) days unless canceled; delivered = purchase + (7k % 41)
  days when delivered; estimated = purchase + (15 + k%13) days.
* order_items: keys from lineitem; price = decimal(18,2) of l_extendedprice;
  freight = decimal(18,2) of price * decimal(4,2) of l_tax.
* customers: customer_unique_id = c_custkey - c_custkey%2 (two keys per human);
  zip = nation key left-padded to 5; city = market segment; state by nation%5.
* sellers: as customers, city = s_name.
* geolocation: three candidate points per nation zip (two tied), lat = -33.5 +
  1.7n (+0.01), lng = -73 + 1.5n (+0.01); nation 24 lies outside the box.
* products: category null when p_size%10=0 else p_type; sizes from p_size.
* category translation: one row per part whose type is not PROMO* (duplicates
  collapse in staging); English = lower(type).
* payments: sequence 1 for every order, plus sequence 2 of 10.00 when k%7=0
  (taken off sequence 1); type by k%4; installments 1 + k%10.
* reviews: one per order; score 1 + (k%16)%5 ('n/a' when k%97=0);
  message by k%8: null, blanks, four fixed complaints, else the full text of a
  document (text-carrying orders numbered consecutively, wrapped at the
  document-id range, so every document is used); created = purchase + 30 days; answered = created + k%9 days,
  null when k%11=0, unparsable when k%89=0; an older duplicate review for
  k%30=1.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.expressions import STATE_BY_NATION

# Fixed values of the adapter.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
REVIEW_MESSAGES = (None, "   ", "Entrega com ATRASO", "produto quebrado", "muito ruim",
                   "Late delivery and broken")
# Keys modulo 8 whose review carries a document text (after the fixed messages).
TEXT_PERIOD = 8
TEXT_SLOTS = tuple(range(len(REVIEW_MESSAGES), TEXT_PERIOD))


def _s(c: Column) -> Column:
    return c.cast("string")


def _plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def _state(nation: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATE_BY_NATION]), (nation % len(STATE_BY_NATION) + 1).cast("int"))


def _zip(nation: Column) -> Column:
    return F.lpad(nation.cast("string"), 5, "0")


class LazyFrames(Mapping):
    """name -> DataFrame, each built on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def bronze_from_testdata(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The nine bronze frames derived from the driver tables in `sf_dir`
    (each built on first access)."""
    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    return LazyFrames({
        "customers": lambda: _customers(t("customer")),
        "geolocation": lambda: _geolocation(t("nation")),
        "order_items": lambda: _order_items(t("lineitem")),
        "order_payments": lambda: _payments(t("orders")),
        "order_reviews": lambda: _reviews(t("orders"), t("documents")),
        "orders": lambda: _orders(t("orders")),
        "category_translation": lambda: _translation(t("part")),
        "products": lambda: _products(t("part")),
        "sellers": lambda: _sellers(t("supplier")),
    })


def _status(k: Column) -> Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
            .when(F.col("o_orderstatus") == "O", F.lit("shipped"))
            .when(F.col("o_orderstatus") == "P",
                  F.when(k % 10 == 0, F.lit("canceled")).otherwise(F.lit("delivered")))
            .otherwise(F.lit("unavailable")))


def _orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    p = F.col("o_orderdate")
    status = _status(k)
    return orders.select(
        _s(k).alias("order_id"),
        _s(F.col("o_custkey")).alias("customer_id"),
        status.alias("order_status"),
        p.alias("order_purchase_timestamp"),
        _plus_days(p, k % 2).alias("order_approved_at"),
        F.when(status != "canceled", _plus_days(p, 1 + k % 3)).alias("order_delivered_carrier_date"),
        F.when(status == "delivered", _plus_days(p, (k * 7) % 41)).alias("order_delivered_customer_date"),
        _plus_days(p, 15 + k % 13).alias("order_estimated_delivery_date"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lineitem.select(
        _s(F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _s(F.col("l_partkey")).alias("product_id"),
        _s(F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,2)").alias("freight_value"),
    )


def _customers(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return customer.select(
        _s(ck).alias("customer_id"),
        _s(ck - ck % 2).alias("customer_unique_id"),
        _zip(F.col("c_nationkey")).alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        _state(F.col("c_nationkey")).alias("customer_state"),
    )


def _sellers(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        _s(F.col("s_suppkey")).alias("seller_id"),
        _zip(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        _state(F.col("s_nationkey")).alias("seller_state"),
    )


def _geolocation(nation: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    j = F.col("j")
    offset = F.lit(Decimal("0.01")) * (j % 2)
    return (nation.select(n, F.col("n_name"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"))
             .select(
                 _zip(n).alias("geolocation_zip_code_prefix"),
                 (F.lit(Decimal("-33.5")) + F.lit(Decimal("1.7")) * n + offset).alias("geolocation_lat"),
                 (F.lit(Decimal("-73.0")) + F.lit(Decimal("1.5")) * n + offset).alias("geolocation_lng"),
                 F.concat_ws("-", F.col("n_name"), _s(j)).alias("geolocation_city"),
                 _state(n).alias("geolocation_state"),
             ))


def _products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select(
        _s(F.col("p_partkey")).alias("product_id"),
        F.when(size % 10 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (size * 10).alias("product_description_lenght"),
        (1 + size % 5).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (1 + size % 7).alias("product_height_cm"),
        (2 + size % 11).alias("product_width_cm"),
    )


def _translation(part: DataFrame) -> DataFrame:
    return (part.filter(~F.col("p_type").startswith("PROMO"))
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english")))


def _payments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    split = k % 7 == 0
    seq = F.col("seq")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    ten = F.lit(Decimal("10.00"))
    return (orders.select(k, total.alias("total"),
                                F.explode(F.when(split, F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1)))).alias("seq"))
                  .select(
                      _s(k).alias("order_id"),
                      seq.alias("payment_sequential"),
                      F.when(seq == 2, F.lit("voucher"))
                       .otherwise(F.element_at(F.array(*[F.lit(x) for x in PAYMENT_TYPES]),
                                               (k % 4 + 1).cast("int"))).alias("payment_type"),
                      F.when(seq == 2, F.lit(1)).otherwise(1 + k % 10).alias("payment_installments"),
                      F.when(seq == 2, ten)
                       .otherwise(F.col("total") - F.when(split, ten).otherwise(F.lit(Decimal("0.00"))))
                       .cast("decimal(18,2)").alias("payment_value"),
                  ))


def _reviews(orders: DataFrame, documents: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    p = F.col("o_orderdate")
    # Review messages: fixed complaints, or the whole text of a document.  The
    # orders carrying a text are TEXT_SLOTS of every TEXT_PERIOD keys; numbering them
    # consecutively and wrapping at the document-id range (a scalar subquery,
    # evaluated once) spreads them over every document of the table.  The
    # join is an ordinary equi-join; its strategy follows the measured sizes.
    slot = None
    for j, r in enumerate(TEXT_SLOTS):
        cond = k % TEXT_PERIOD == r
        slot = F.when(cond, F.lit(j)) if slot is None else slot.when(cond, F.lit(j))
    n_docs = documents.agg(F.max("doc_id") + 1).scalar()
    text_index = ((k - k % TEXT_PERIOD) / TEXT_PERIOD).cast("long") * len(TEXT_SLOTS) + slot
    docs = documents.select(F.col("doc_id"), F.col("text").alias("doc_text"))
    reviewed = orders.select(
        k, p, F.when(k % TEXT_PERIOD >= len(REVIEW_MESSAGES), text_index % n_docs).alias("doc_id"))
    msg = None
    for i, text in enumerate(REVIEW_MESSAGES):
        value = F.lit(text).cast("string")
        msg = F.when(k % 8 == i, value) if msg is None else msg.when(k % 8 == i, value)
    msg = msg.otherwise(F.col("doc_text"))
    # orders without a text have no key: they are no part of the join
    matched = reviewed.filter(F.col("doc_id").isNotNull()).join(docs, "doc_id", "left").unionByName(
        reviewed.filter(F.col("doc_id").isNull()).withColumn("doc_text", F.lit(None).cast("string")))
    main = matched.select(
        F.concat(F.lit("rev-"), _s(k)).alias("review_id"),
        _s(k).alias("order_id"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(_s(1 + (k % 16) % 5)).alias("review_score"),
        F.when(k % 5 == 0, F.lit("Recomendo")).alias("review_comment_title"),
        msg.alias("review_comment_message"),
        _s(_plus_days(p, F.lit(30))).alias("review_creation_date"),
        F.when(k % 89 == 0, F.lit("not a date"))
         .when(k % 11 != 0, _s(_plus_days(p, 30 + k % 9))).alias("review_answer_timestamp"),
    )
    older = orders.filter(k % 30 == 1).select(
        F.concat(F.lit("rev-"), _s(k)).alias("review_id"),
        _s(k).alias("order_id"),
        _s(1 + ((k + 1) % 16) % 5).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit("avaliacao anterior").alias("review_comment_message"),
        _s(_plus_days(p, F.lit(29))).alias("review_creation_date"),
        _s(_plus_days(p, F.lit(29))).alias("review_answer_timestamp"),
    )
    return main.unionByName(older)
