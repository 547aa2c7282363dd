"""Queries over the supplied tables, each with the SQL that must give the same rows where SQL can say it."""

from martloom.queries import checks, faults, growth, loading, marts, merging, pipelines, shaping, streams  # noqa: F401
from martloom.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
