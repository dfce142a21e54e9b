"""All registered queries: importing a query module fills the registry."""

from clickloom.plans import (event_queries, operations_queries, report_queries, stream_queries,
                             table_queries)
from clickloom.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
