"""Reusable DataFrame operators.

topn        top-1 row per key as one map-side-combined aggregation
lookup      left lookups against dimension-like tables, with defaults
quality     unique / not_null checks and a suite from one aggregation per key
cumulative  running totals and ranks over range partitions (no single-task window)
spine       entity x month spines generated inside tasks
"""
