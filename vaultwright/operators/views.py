"""Views over stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def create_stage_view(stage: DataFrame, name: str) -> str:
    """Create or replace the view ``stg_<name>`` and return a status text."""
    if not name.isidentifier():
        raise ValueError(f"{name!r} is not a table name")
    view = f"stg_{name}"
    stage.createOrReplaceTempView(view)
    return f"view created for {name}: {view}"
