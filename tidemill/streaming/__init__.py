"""Streaming entry points.

The original flows run batch loads only; the one streaming form offered here is
the same keyed upsert applied to each micro-batch of a Structured Streaming
query, so a table can be fed continuously with the load semantics unchanged.
"""

from tidemill.streaming.upsert_sink import latest_per_key, upsert_stream  # noqa: F401
