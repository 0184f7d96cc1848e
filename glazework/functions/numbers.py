"""Numeric and boolean expressions (E-16 … E-19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions.text import trim_ws


def clean_currency(raw: Column) -> Column:
    """E-16: keep digits and dots, empty → NULL, safe cast to double, round to pence.

    A minus sign or a currency word is dropped with the other characters;
    ``1.2.3`` and ``.`` fail the cast and give NULL. Spark rounds the decimal
    form of the double half-up, so ``1.005`` → 1.01. More digits than a double
    can hold are no amount either: NULL, not infinity.
    """
    kept = F.nullif(F.regexp_replace(raw, K.CURRENCY_STRIP, ""), F.lit(""))
    amount = kept.try_cast("double")
    return F.round(F.nullif(amount, F.lit(float("inf"))), K.MONEY_SCALE)


def money_difference(a: Column, b: Column) -> Column:
    """E-17: a − b rounded to pence; NULL if either is NULL."""
    return F.round(a - b, K.MONEY_SCALE)


def clean_rating(raw: Column) -> Column:
    """E-18: N/A or empty → NULL; number words → their value; else safe integer cast.

    Out-of-range ratings (0, 6) pass through; ``5.0`` is not an integer → NULL.
    The cast is attempted only on integer-shaped text: a failing cast costs an
    exception per row, ten times the price of the pattern test.
    """
    lt = F.lower(trim_ws(raw))
    expr = F.when(lt.isin(K.RATING_NULL_WORDS), F.lit(None).cast("bigint"))
    for word, value in K.RATING_WORDS:
        expr = expr.when(lt == word, F.lit(value).cast("bigint"))
    return expr.when(raw.rlike(r"^\s*[+-]?[0-9]+\s*$"), raw.try_cast("bigint")).otherwise(F.lit(None).cast("bigint"))


def clean_boolean(raw: Column) -> Column:
    """E-19: yes/y/true/1 → TRUE, no/n/false/0 → FALSE, anything else → NULL."""
    lt = F.lower(trim_ws(raw))
    return (
        F.when(lt.isin(K.BOOLEAN_TRUE_WORDS), F.lit(True))
        .when(lt.isin(K.BOOLEAN_FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )
