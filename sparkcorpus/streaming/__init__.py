"""Incremental twins of batch operators."""
