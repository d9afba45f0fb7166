"""Every query of the library over the driver's tables."""

from isobar.plans.catalog import groups, joins, loads, models, rows, runs, scans, windows  # noqa: F401
from isobar.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
