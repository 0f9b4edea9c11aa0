"""Queries over the driver tables and the SQL that checks them."""

from folioflow.queries import enrichment, lookups, relational, scalars, selection, streams
from folioflow.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "enrichment", "lookups", "relational", "scalars", "selection", "streams"]
