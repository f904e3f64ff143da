"""Imports every plan module so that the registry is complete."""

from . import chains, detection, documents, expressions, fetching, maintenance, market, retrieval, social, storage, streams  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
