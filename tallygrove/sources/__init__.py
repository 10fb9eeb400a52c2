"""Readers and writers for tables, scores and fitted pipelines."""
