"""The seven jobs, each composed from the operators."""
