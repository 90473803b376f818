"""Registered queries: each operator applied to the given tables."""

from turnweave.catalog import completions, files, judging, prompts, runs, staging, training
from turnweave.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
