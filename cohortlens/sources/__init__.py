"""Inputs and outputs.

tables  parquet / orc / json / csv ingestion with explicit mapping, preamble rows,
        absent columns, override cell and ingestion order (S1-S5, S8)
tpch    the test-table mapping (FIXTURES.md §3) and derived messy inputs
sinks   flat outputs partitioned by scope, partition-pruned slices, the document (S6, S7, F8)
"""
