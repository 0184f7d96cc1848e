"""Jobs: staging (J-01), dimensions (J-02), fact (J-03), tests (J-04), whole build (J-05)."""

from glazework.plans.build import Warehouse, build_warehouse, current_run, publish, published, register_views
from glazework.plans.marts import DIMENSIONS, FACT_COLUMNS, build_dimensions, build_fact
from glazework.plans.staging import STAGING_COLUMNS, build_staging, clean_columns, clean_rows

__all__ = [
    "DIMENSIONS",
    "FACT_COLUMNS",
    "STAGING_COLUMNS",
    "Warehouse",
    "build_dimensions",
    "build_fact",
    "build_staging",
    "build_warehouse",
    "clean_columns",
    "clean_rows",
    "current_run",
    "publish",
    "published",
    "register_views",
]
