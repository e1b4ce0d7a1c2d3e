"""Restartable, idempotent batch pipelines as plain PySpark DataFrame operators."""
