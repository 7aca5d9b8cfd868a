"""JSON helpers for run-log ``details`` text (``details:a.b::TYPE`` in the reference dialect)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXPECTATIONS_TYPE = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def json_path(c, path: str, cast: str | None = None) -> Column:
    """Value at ``$.path`` of a JSON text column, optionally cast (NULL when absent)."""
    col = F.col(c) if isinstance(c, str) else c
    v = F.get_json_object(col, f"$.{path}")
    return v.cast(cast) if cast else v


def expectations(c) -> Column:
    """The ``flow_progress.data_quality.expectations`` array parsed to structs."""
    return F.from_json(json_path(c, "flow_progress.data_quality.expectations"), EXPECTATIONS_TYPE)
