"""Test views, queries and their SQL counterparts over the given tables."""
