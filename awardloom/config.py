"""Engine settings with defaults that survive empty sections."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from . import schema


@dataclass(frozen=True)
class EngineConfig:
    """What the award jobs need to know; every section has a usable default."""

    column_mapping: Mapping[str, str] = field(default_factory=lambda: dict(schema.COLUMN_MAPPING))
    optional_columns: tuple[str, ...] = schema.OPTIONAL_SOURCE_COLUMNS
    date_columns: tuple[str, ...] = schema.DATE_COLUMNS
    numeric_columns: tuple[str, ...] = schema.NUMERIC_COLUMNS
    boolean_columns: tuple[str, ...] = schema.BOOLEAN_COLUMNS
    text_columns: tuple[str, ...] = schema.TEXT_COLUMNS
    default_filters: Mapping[str, Any] = field(default_factory=dict)
    required_fields: tuple[str, ...] = schema.REQUIRED_FIELDS
    fiscal_year_limits: tuple[int, int] | None = schema.FISCAL_YEAR_LIMITS
    min_dollars_limit: int | None = schema.MIN_DOLLARS_LIMIT
    max_dollars_limit: int | None = None
    dedup_keys: tuple[str, ...] = schema.AWARD_KEYS
    output_format: str = "parquet"
    #: Whether a text result is packed (gzip, files of bounded size).
    pack_text: bool = True
    include_quality_report: bool = True
    include_summary: bool = True

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any] | None) -> "EngineConfig":
        """Build from a parsed settings file; null or missing sections keep defaults."""
        raw = raw or {}
        types = raw.get("data_types") or {}
        quality = raw.get("data_quality") or {}
        output = raw.get("output") or {}
        rules = quality.get("validation_rules") or {}
        found = {
            "column_mapping": raw.get("column_mapping"),
            "optional_columns": raw.get("optional_columns"),
            "date_columns": types.get("date_columns"),
            "numeric_columns": types.get("numeric_columns"),
            "boolean_columns": types.get("boolean_columns"),
            "text_columns": types.get("text_columns"),
            "default_filters": raw.get("default_filters"),
            "required_fields": quality.get("required_fields"),
            "fiscal_year_limits": rules.get("fiscal_year_range"),
            "min_dollars_limit": rules.get("min_dollars_obligated"),
            # Configured ceilings are only applied when enforcement is asked for.
            "max_dollars_limit": rules.get("max_dollars_obligated") if rules.get("enforce_max") else None,
            "output_format": output.get("format"),
            "pack_text": output.get("pack_text"),
            "include_quality_report": output.get("include_quality_report"),
            "include_summary": output.get("include_summary"),
        }
        tuples = {f.name for f in fields(cls) if "tuple" in str(f.type)}
        return cls(
            **{k: tuple(v) if k in tuples else v for k, v in found.items() if v is not None}
        )
