"""Registered queries over the given tables; importing the modules fills the registry."""

from stallmetrics.plans import (  # noqa: F401
    loads, order_audits, order_reports, page_extraction, price_reports, streams, text_rules)
from stallmetrics.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
