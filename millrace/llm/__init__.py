"""Operators for training data: joins of near copies, repeats, quality, language, scoring and output."""
