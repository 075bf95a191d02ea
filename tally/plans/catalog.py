"""All named queries; importing the modules registers them."""

from tally.plans import basic_queries, check_queries, counted_queries, report_queries, stored_queries  # noqa: F401
from tally.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
