"""File exports: the mapped records as Parquet or CSV under a path that may carry the run's date."""

from __future__ import annotations

from collections.abc import Mapping as Dict
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from syncloom.functions.columns import nest, quoted
from syncloom.plans.spec import SpecError
from syncloom.session import replace


def render_path(template: str, run_at: datetime) -> str:
    """Date tokens (``%m-%d-%y`` ...) filled in from the run's time."""
    return run_at.strftime(template)


def _truth(value: Any) -> bool:
    return value.strip().lower() == "true" if isinstance(value, str) else bool(value)


def export_file(df: DataFrame, template: str, config: Dict[str, Any], run_at: datetime, root: str = "") -> str:
    """Write the records, one file per task, into the directory the template names; returns that path.

    The files are written beside it and take its place once they are complete, so a failed run leaves the earlier export.
    Arrays and other nested values are JSON text in CSV.
    """
    path = f"{root.rstrip('/')}/{render_path(template, run_at)}" if root else render_path(template, run_at)
    kind = str(config.get("file_format", "")).lower()
    if kind == "parquet":
        nest(df).write.mode("overwrite").parquet(f"{path}.writing")
    elif kind == "csv":
        nested = (T.ArrayType, T.MapType, T.StructType)
        flat = df.select(*[(F.to_json(quoted(f.name)) if isinstance(f.dataType, nested) else quoted(f.name)).alias(f.name) for f in df.schema.fields])
        writer = flat.write.mode("overwrite").option("sep", config.get("csv_delimiter", ","))
        writer.option("header", _truth(config.get("csv_include_header", True))).csv(f"{path}.writing")
    else:
        raise SpecError(f"unsupported file format {config.get('file_format')!r}")
    replace(df.sparkSession, f"{path}.writing", path)
    return path
