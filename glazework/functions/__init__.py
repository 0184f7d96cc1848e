"""Column expressions used by the staging and mart jobs.

All of them are compositions of built-in ``pyspark.sql.functions``: they run
inside whole-stage code generation on the executors and never call Python per
row. Each takes and returns a ``Column``; NULL in gives NULL out unless noted.
"""

from glazework.functions.dates import (
    date_key,
    day_name,
    day_of_week,
    is_weekend,
    month_name,
    parse_repair_date,
)
from glazework.functions.keys import prefixed_id, surrogate_key
from glazework.functions.numbers import clean_boolean, clean_currency, clean_rating, money_difference
from glazework.functions.text import (
    clean_city,
    clean_email,
    clean_postcode,
    clean_region,
    clean_vehicle_brand,
    clean_vehicle_model,
    initcap_words,
    parse_full_name,
    trim_ws,
    uk_mobile,
)

__all__ = [
    "clean_boolean",
    "clean_city",
    "clean_currency",
    "clean_email",
    "clean_postcode",
    "clean_rating",
    "clean_region",
    "clean_vehicle_brand",
    "clean_vehicle_model",
    "date_key",
    "day_name",
    "day_of_week",
    "initcap_words",
    "is_weekend",
    "money_difference",
    "month_name",
    "parse_full_name",
    "parse_repair_date",
    "prefixed_id",
    "surrogate_key",
    "trim_ws",
    "uk_mobile",
]
