"""The registered queries: each runs an operator over the test tables, with the SQL
that a second engine runs on the same tables."""

from workload import aggregates, checks, landing, shaping, streams, timelines
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "checks", "landing", "shaping", "streams", "timelines"]
