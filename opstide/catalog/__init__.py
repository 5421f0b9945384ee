"""Registered queries over the driver's tables, one key per operator."""

from . import (  # noqa: F401
    q_disk,
    q_features,
    q_locks,
    q_models,
    q_reports,
    q_rollups,
    q_sources,
    q_streams,
    q_windows,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
