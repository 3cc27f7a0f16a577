"""Registered queries: each operator applied to the given tables, with its SQL equivalent."""

from wattloom.catalogue import anomalies, civil, demand, features, forecasting, ingest, quality, served, streams  # noqa: F401
from wattloom.catalogue.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
