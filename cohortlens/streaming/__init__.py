"""Incremental ingestion: micro-batch partial rollups merged at build time.

The source computation is batch-only; this is an ingestion mode for event
tables that grow, not an extra operator.
"""
