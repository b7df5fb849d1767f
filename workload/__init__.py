"""The registered queries: every operator run on the given tables, with its SQL twin."""

from workload import normalising, reporting, scalars, scans, selection, storing  # noqa: F401
from workload.registry import ORACLES, QUERIES, raw

__all__ = ["ORACLES", "QUERIES", "raw"]
