"""ticklake: market-tick quality, OHLCV candles, drift and storage on Spark.

Every operator is ``DataFrame -> DataFrame`` built from Spark SQL
expressions, windows, joins and Structured Streaming; nothing collects
data to the driver and nothing runs a row-at-a-time Python UDF.
"""

__version__ = "0.1.0"
