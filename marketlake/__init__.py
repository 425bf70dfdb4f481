"""marketlake — a Spark-native marketplace analytics engine.

Raw marketplace files (orders, items, payments, reviews, customers, sellers,
products, locations) go in; typed staging tables, a dimensional core and
business marts come out.  Every model is a pure function over PySpark
DataFrames: no reads and no actions inside, so Catalyst sees one plan per
query and prunes, pushes down and reuses exchanges across the whole DAG.
"""

__version__ = "0.1.0"
