"""Market time series on Spark: bars, indicators, VWAP, pairing, table layers.

Every operator is a ``DataFrame -> DataFrame`` transform (or a ``Column``
builder), so batch and streaming share one code path wherever Spark allows it.
Timestamps are UTC; run with ``spark.sql.session.timeZone=UTC``.
"""
