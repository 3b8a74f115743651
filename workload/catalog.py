"""All queries, by importing the modules that register them."""

from workload import (  # noqa: F401
    applied_queries,
    calendar_queries,
    decode_queries,
    job_queries,
    ledger_queries,
    statistics_queries,
    streaming_queries,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
