"""Identifier and surrogate-key expressions (E-01, E-21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glazework import constants as K


def prefixed_id(prefix: str, raw_id: Column) -> Column:
    """E-01: ``prefix || id``; NULL id → NULL (Spark ``concat`` propagates NULL)."""
    return F.concat(F.lit(prefix), raw_id.cast("string"))


def surrogate_text(*cols: Column | str) -> Column:
    """What a surrogate key hashes: the '-'-joined string forms, NULL spelled as a fixed token."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(K.SURROGATE_KEY_NULL))
        for c in cols
    ]
    return F.concat_ws(K.SURROGATE_KEY_SEPARATOR, *parts)


def surrogate_key(*cols: Column | str) -> Column:
    """E-21: md5 hex of :func:`surrogate_text`."""
    return F.md5(surrogate_text(*cols))
