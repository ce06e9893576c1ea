"""Registered queries of the operators, each with its oracle where SQL has one."""

from . import gold, quality, serving, sources, space, statistics  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
