"""Importing the package registers every query."""

from lumentab.plans import clustering, learning, panels, preparation, profiling, scoring, statistics  # noqa: F401
from lumentab.plans.registry import ORACLES, PLANS

__all__ = ["ORACLES", "PLANS"]
