"""Joins, aggregates, ordering, sinks, fault handling, ledger and metrics."""
