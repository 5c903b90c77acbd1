"""The reference's analytics wired to the driver tables; importing registers them."""

from eventflow.plans import hotitems, loginfail, market, networkflow, orderpay, streams  # noqa: F401
from eventflow.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
