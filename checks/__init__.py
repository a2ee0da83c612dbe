"""Registered queries: every operator over the given tables, beside its SQL."""

from checks.registry import ORACLES, QUERIES  # noqa: F401
from checks import bars, grids, ingest, jobs, mutations, streams  # noqa: F401
