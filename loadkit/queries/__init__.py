"""Demonstration queries over the given tables, each with SQL that gives the same rows."""

from loadkit.queries import history, ledger, loads, merging, metadata, shaping, sinks, sources, validation  # noqa: F401
from loadkit.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
