"""Queries over the driver tables, each with the SQL that must give the same rows."""

from workload import answers, charts, counts, crosstabs, flows, full_report, ranks, reports, sets
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
