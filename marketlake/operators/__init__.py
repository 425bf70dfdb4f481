"""Reusable relational operators built from DataFrame primitives."""

from marketlake.operators.aggregates import distinct_then_avg, histogram, top_k
from marketlake.operators.dedup import keep_first

__all__ = ["keep_first", "distinct_then_avg", "histogram", "top_k"]
