"""Incremental (Structured Streaming) forms of the revenue operators.

The reference is batch-only; this package only re-runs the same daily /
monthly revenue aggregation incrementally as new transaction files land.
"""

from tidemark.streaming.revenue_stream import daily_revenue_stream, start_daily_revenue  # noqa: F401
