"""barwright: typed market bars, indicator features and quality reports on Spark.

Bars are a DataFrame keyed by (symbol, interval, open_time) and partitioned by
(symbol, interval, date). Features are computed per chunk (one UTC day plus a
warm-up tail of the previous day), so many symbols and days run in parallel.
"""

__version__ = "0.1.0"
