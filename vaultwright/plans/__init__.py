"""The registered queries: every operator over whole tables, next to its SQL."""

from vaultwright.plans import checks, cleansing, hubs, jobs, keys, links, safety, satellites, sources  # noqa: F401
from vaultwright.plans.registry import QUERIES

__all__ = ["QUERIES"]
