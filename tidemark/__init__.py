"""Tidemark: analytics for early signals in works, mentions and news, as PySpark DataFrames."""
