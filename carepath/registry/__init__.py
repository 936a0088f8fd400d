"""All registered queries, by name."""

from . import (  # noqa: F401
    aggregates,
    care,
    charts,
    coding,
    dashboards,
    lookups,
    options,
    pathway,
    people,
    periods,
    readmit,
    stored,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
