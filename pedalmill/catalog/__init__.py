"""Registered queries over the given tables, and the SQL each is compared with."""

from . import (aggregates, cohorts, flows, intake, joins, models, places, quality, scalars, schedules,  # noqa: F401
               windows)
from .registry import COVERS, ORACLES, QUERIES

__all__ = ["COVERS", "ORACLES", "QUERIES"]
