"""The operators applied to star-schema tables, and the same answers in SQL."""
