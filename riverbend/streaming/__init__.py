"""Structured Streaming consumers: typed JSON streams, event-time windows
with watermarks, filtered projections, per-batch guards, CDC apply and
model scoring.  Each has a batch twin in ``riverbend.operators``."""
