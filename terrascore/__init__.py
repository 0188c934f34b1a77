"""terrascore — Spark-native country indicator analytics.

Long-format (country, year, value) observations for a fixed set of indicators
become a star schema (two dimensions, three wide facts), a scored and ranked
composite index, and analytical views — all as DataFrame / SQL plans.
"""

__version__ = "0.1.0"
