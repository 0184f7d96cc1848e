"""Relational and data-quality operators, each a DataFrame → DataFrame job."""

from glazework.operators.date_spine import date_spine, dim_date
from glazework.operators.dedupe import dedupe_cleaned, dedupe_rows, duplicate_report, repeated_ids
from glazework.operators.dimension import build_dimension, key_collisions, lookup_key
from glazework.operators.fanout import fanout_forecast
from glazework.operators.lookup import map_codes, region_lookup, with_region_lookup
from glazework.operators.quality import (
    boolean_violations,
    not_null_violations,
    observe_row_tests,
    quality_summary,
    unique_violations,
    unmapped_violations,
)

__all__ = [
    "boolean_violations",
    "build_dimension",
    "date_spine",
    "dedupe_cleaned",
    "dedupe_rows",
    "dim_date",
    "duplicate_report",
    "fanout_forecast",
    "key_collisions",
    "lookup_key",
    "map_codes",
    "not_null_violations",
    "observe_row_tests",
    "quality_summary",
    "region_lookup",
    "repeated_ids",
    "unique_violations",
    "unmapped_violations",
    "with_region_lookup",
]
