"""Scans of delimited files, whole files, id ranges and pages."""
