"""The registered queries."""

from . import governance, history, ingest, journeys, products, recipes, service_levels  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
