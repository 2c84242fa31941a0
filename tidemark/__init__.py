"""tidemark: per-symbol market-signal analytics on Spark.

Ticks -> OHLCV bars -> rolling features -> risk components -> 0-100 score,
reasons, alerts and events, as batch DataFrame jobs and Structured Streaming
jobs. Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function; Catalyst plans the work.
"""

__version__ = "0.1.0"
