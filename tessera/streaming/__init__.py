"""Structured Streaming: the reference has no stream, watermark or stateful
operator (SURVEY 2.11), so nothing is built here. Every operator in the
library is a function of DataFrames without actions of its own (apart from
the few bounded look-ups documented in the README), so the row-wise ones
(filters, projections, Column functions) apply unchanged to a streaming
DataFrame from ``spark.readStream``."""
