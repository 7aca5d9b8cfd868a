"""The full query catalog: importing it registers every query module."""

from __future__ import annotations

from .registry import ORACLE, QUERIES  # noqa: F401
from . import q_quality, q_cdc, q_gold  # noqa: E402,F401
from . import q_governance, q_snapshots, q_monitoring, q_streams, q_ingest, q_layout, q_pipeline  # noqa: E402,F401
