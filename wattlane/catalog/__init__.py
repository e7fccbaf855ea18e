"""Registered queries over the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from wattlane.catalog import cleaning, modelling, report, solved, storage, stream  # noqa: F401
from wattlane.catalog.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
