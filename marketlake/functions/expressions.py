"""Scalar and aggregate expression builders.

Everything here returns a `pyspark.sql.Column`; nothing touches data.  Money
arrives as double (the staging contract) with up to six decimals.  A sum is
taken over two longs, whole amounts and millionths: exact, independent of
partitioning and summation order, with fixed-width aggregation buffers, and
with room for totals up to 9.2e18.  Results are converted back to double at
the end (a correctly rounded division by 10^6).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "CANCELED_STATUSES",
    "DEFAULT_HUB",
    "DELIVERY_STATUSES",
    "HUBS",
    "KEYWORD_GROUPS",
    "STATE_BY_NATION",
    "TOTAL",
    "UNITS",
    "amount",
    "amount_sum",
    "amount_total",
    "contains_any",
    "count_if",
    "days_between",
    "exact_avg",
    "exact_ratio",
    "from_units",
    "hub_for_state",
    "in_units",
    "money_sum",
    "pct",
    "round_money_sum",
    "rounded_units",
    "surrogate_key",
]

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Order statuses that count as canceled in the delivery classification.
CANCELED_STATUSES = ("canceled", "unavailable")

# Delivery performance labels, in branch order: canceled, on time, late, else.
DELIVERY_STATUSES = ("Canceled / Unavailable", "On Time / Early", "Late", "In Flight")

# Review complaint keyword groups (substring match on lower-cased text).
KEYWORD_GROUPS = {
    "delay_complaint_count": ("atraso", "demor", "late", "delay"),
    "damage_complaint_count": ("estragad", "quebrad", "damag", "broken"),
    "poor_quality_complaint_count": ("pessim", "ruim", "bad", "poor"),
}

# Regional hubs: name, latitude, longitude, capacity, and the customer state
# each serves.  Every other state routes to the Sao Paulo hub.
HUBS = (
    ("Sao Paulo Hub", Decimal("-23.5505"), Decimal("-46.6333"), 150000, "SP"),
    ("Rio de Janeiro Hub", Decimal("-22.9068"), Decimal("-43.1729"), 90000, "RJ"),
    ("Belo Horizonte Hub", Decimal("-19.9167"), Decimal("-43.9345"), 60000, "MG"),
)
DEFAULT_HUB = HUBS[0]

# Test-data adapter: state assigned by nation key modulo 5.
STATE_BY_NATION = ("SP", "RJ", "MG", "RS", "BA", "PR", "SC", "PE")

# ---------------------------------------------------------------------------


#: Amounts are summed as whole millionths: exact for inputs with up to six decimals.
UNITS = 1_000_000

#: Type of a total in millionths: amounts up to 10^18.
TOTAL = "decimal(25,0)"


def amount(c: Column | str) -> Column:
    """An amount as two longs: whole amounts and millionths (both with the amount's sign)."""
    c = F.col(c) if isinstance(c, str) else c
    u = F.rint(c * F.lit(float(UNITS))).cast("long")
    return F.struct(_div(u).alias("whole"), (u % UNITS).alias("part"))


def _div(u: Column) -> Column:
    """Whole amounts in millionths, towards zero; `div` keeps longs, `/` would not."""
    return F.call_function("div", u, F.lit(UNITS).cast("long"))


def amount_total(a: Column | str, weight: Column | None = None, when: Column | None = None) -> Column:
    """Exact sum of amounts (see `amount`), each `weight` times; rows where `when` does not hold add 0.

    Both longs are summed on their own, so aggregation buffers stay two longs wide, and the sum holds
    10^6 times as much as a sum of millionths would: whole amounts up to 9.2e18, over up to 9.2e12 rows.
    """
    a = F.col(a) if isinstance(a, str) else a

    def total(limb: str) -> Column:
        x = a.getField(limb)
        x = x if weight is None else x * weight
        return F.sum(x if when is None else F.when(when, x).otherwise(F.lit(0).cast("long")))

    whole, part = total("whole"), total("part")
    return F.struct((whole + _div(part)).alias("whole"), (part % UNITS).alias("part"))


def amount_sum(c: Column | str) -> Column:
    """Exact sum of a double amount, as two longs."""
    return amount_total(amount(c))


def in_units(total: Column) -> Column:
    """A total of two longs as millionths (decimal)."""
    return (total.getField("whole").cast("decimal(19,0)") * F.lit(Decimal(UNITS)) + total.getField("part").cast("decimal(19,0)")).cast(TOTAL)


def from_units(total: Column) -> Column:
    """Millionths (decimal) back to a double amount."""
    return total.cast("double") / F.lit(float(UNITS))


def rounded_units(total: Column, scale: int = 2) -> Column:
    """Millionths (decimal) as an amount rounded half-up, as double."""
    return F.round(total / F.lit(Decimal(UNITS)), scale).cast("double")


def money_sum(c: Column | str) -> Column:
    """Exact sum of an amount, as double."""
    return from_units(in_units(amount_sum(c)))


def round_money_sum(c: Column | str, scale: int = 2) -> Column:
    """`round(sum(x), scale)` computed exactly, returned as double."""
    return rounded_units(in_units(amount_sum(c)), scale)


def exact_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """round(numerator / denominator, scale) with decimal arithmetic.

    The quotient is formed at >= 12 decimal places before rounding half-up, so
    the result does not depend on floating point summation order.  Null when
    the denominator is 0 or null.
    """
    den = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(numerator / den, scale).cast("double")


def exact_avg(c: Column | str, scale: int, is_money: bool = False) -> Column:
    """round(avg(x), scale) over non-null x, computed exactly."""
    c = F.col(c) if isinstance(c, str) else c
    if is_money:
        return exact_ratio(in_units(amount_sum(c)), F.count(c).cast("decimal(20,0)") * F.lit(Decimal(UNITS)), scale)
    return exact_ratio(F.sum(c.cast("long")).cast("decimal(20,0)"), F.count(c), scale)


def count_if(cond: Column) -> Column:
    """`count(case when cond then 1 end)`: null conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


def pct(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """`round(n * 100.0 / nullif(d, 0), scale)` for counts, as double."""
    num = numerator.cast("decimal(20,0)") * F.lit(Decimal("100.0"))
    den = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(num / den, scale).cast("double")


def days_between(end: Column | str, start: Column | str) -> Column:
    """Calendar days from start to end (`datediff`), time of day ignored."""
    end = F.col(end) if isinstance(end, str) else end
    start = F.col(start) if isinstance(start, str) else start
    return F.datediff(F.to_date(end), F.to_date(start))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over `-`-joined parts, each null part replaced by ''."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


def contains_any(text: Column, needles: tuple[str, ...]) -> Column:
    """OR of substring tests (`like '%needle%'`)."""
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def hub_for_state(state: Column | str) -> Column:
    """Struct(hub_name, hub_lat, hub_lon) for a customer state."""
    state = F.col(state) if isinstance(state, str) else state

    def pick(idx: int) -> Column:
        expr = None
        for hub in HUBS:
            cond = state == F.lit(hub[4])
            expr = F.when(cond, F.lit(hub[idx])) if expr is None else expr.when(cond, F.lit(hub[idx]))
        return expr.otherwise(F.lit(DEFAULT_HUB[idx]))

    return F.struct(
        pick(0).alias("hub_name"),
        pick(1).cast("double").alias("hub_lat"),
        pick(2).cast("double").alias("hub_lon"),
    )
