"""Named queries over the given tables, with equivalent SQL where SQL can express them."""

from perfwatch.plans.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
