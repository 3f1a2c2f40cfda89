"""Operators of a training-data pipeline, and their queries. Nothing outside this folder imports it."""

from . import (  # noqa: F401
    conversations, decision_list, decontaminate, entropy_secrets, kneser_ney, line_dedup, mixing_lm, packing, periodic_runs, rendezvous,
    simhash, token_files, toxicity)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
