"""Queries on the given tables, with the SQL each is compared to."""
