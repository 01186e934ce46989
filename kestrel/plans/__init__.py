"""Registered queries: every operator of the inventory applied to the proxy
views, each paired (where SQL can express it) with an oracle SQL text."""

from kestrel.plans.registry import ORACLE, QUERIES, all_oracles, all_queries  # noqa: F401
