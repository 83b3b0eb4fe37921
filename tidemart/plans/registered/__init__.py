"""Registered queries over the TPC-H-like tables, each with the SQL that must give the same rows."""

from tidemart.plans.registered import features, files, quality, relational, sales, streams, warehouse  # noqa: F401
from tidemart.plans.registered.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
