"""Registered queries: every operator run over the given tables, with an SQL oracle."""

from .registry import oracles, queries

__all__ = ["oracles", "queries"]
