"""Importing this module registers every query."""

from dailypanel.queries import evaluations, linear_models, model_checks, models, panels, profiles, splits, stored  # noqa: F401
from dailypanel.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
