"""Governed bronze, silver and gold tables from declarative contracts, on plain Spark."""

from .contract import Contract, Field, ForeignKey, Rule, Scd2, Source, fields

__all__ = ["Contract", "Field", "ForeignKey", "Rule", "Scd2", "Source", "fields"]
