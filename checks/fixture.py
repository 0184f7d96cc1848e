"""Test input: a dirty repairs table derived from the driver's TPC-H-style tables.

One raw repair job per order (orders ⋈ customer ⋈ nation ⋈ region), with the kinds of
dirt the source system sends. Values and dirt are drawn by separate hashes of the order
key, so every value meets every kind of dirt. One recipe, in integer and string
arithmetic, is spelled for Spark and for DuckDB; the oracle's SQL starts from the latter.

1% of the orders (key ≡ 7 mod 100) are sent twice as exact copies, 1% (≡ 9) twice with
another duration, so one job id has two cleaned rows.

Variant ``repeat_customers`` keys customers by the order's customer, so one customer id
carries several attribute tuples (fan-out of the fact join); ``vary_technicians``
does the same for technicians, whose key hashes the id alone, so one key names two rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glazework.constants import EMAIL_REPAIR_DOMAINS, MAPPED_COLUMNS, NA_TOKEN, NAME_PREFIXES
from glazework.session import tune_for_wide_rows
from glazework.sources.raw import RAW_COLUMNS
from glazework.sources.seeds import seed_rows

BRANDS = ["Ford", "BMW", "Mercedes-Benz", "Land Rover", "KTM"]
MODELS = ["T-Roc", "R 1250 GS", "X-Trail", "Lion's City", "XC40"]
FIRST_NAMES = ["Ann", "Bob", "Mary Jane", "Li"]
RATINGS = ["1", "2", "3", "4", "5", "0", "6", "five", "one", " Five ", "3.5", "N/A", "", None]
BOOLEANS = ["True", "False", "1", "0", "Yes", "No", "Y", "N", " TRUE ", "maybe", "", None]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
BAD_DATES = ["not a date", "31/02/2022", "15/06/2035", "2021-03-04", "", None]
#: Kinds of dirt of a coded value; the last places of the draw leave it as it is.
CODE_DIRT = ["na", "null", "lower", "upper", "spaces", "tab"]
CODE_DRAWS = 16


def code_pool(column: str) -> list[str]:
    """Raw spellings of a coded column: those its seed knows, and one it doesn't."""
    if column == "vehicle_brand":
        return BRANDS
    if column == "vehicle_model":
        return MODELS
    return [raw for raw, _ in seed_rows(column)] + ["Unheard of"]


@dataclass(frozen=True)
class Dialect:
    """The few spellings that the two engines don't share."""

    text: str
    divide: str
    spark: bool

    def lit(self, value: str | None) -> str:
        if value is None:
            return f"CAST(NULL AS {self.text})"
        if self.spark:
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "'" + value.replace("'", "''") + "'"

    def pick(self, values: list[str | None], index: str) -> str:
        if self.spark:
            return f"element_at(array({', '.join(map(self.lit, values))}), CAST({index} + 1 AS INT))"
        return f"([{', '.join(map(self.lit, values))}])[CAST({index} AS BIGINT) + 1]"

    def whole(self, a: str, b: str) -> str:
        return f"(({a}) {self.divide} ({b}))"

    def chars(self, e: str) -> str:
        return f"CAST({e} AS {self.text})"

    def digits(self, e: str, n: int) -> str:
        return f"lpad({self.chars(e)}, {n}, '0')"

    def join(self, *parts: str) -> str:
        return "(" + " || ".join(parts) + ")"

    def draw(self, name: str, n: int) -> str:
        """A number from 0 to n - 1: high bits of the key times an odd constant that the name gives."""
        factor = int.from_bytes(hashlib.sha256(name.encode()).digest()[:4], "big") | 1
        return f"({self.whole(f'(k * {factor}) % 4294967296', '65536')} % {n})"


SPARK = Dialect("STRING", "div", True)
DUCKDB = Dialect("VARCHAR", "//", False)


def _cases(subject: str, branches: list[str], rest: str) -> str:
    """``branches`` by number of the subject, else ``rest``."""
    listed = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(branches))
    return f"CASE {subject} {listed} ELSE {rest} END"


def _dirty(d: Dialect, name: str, value: str) -> str:
    kinds = {
        "na": d.lit(NA_TOKEN), "null": d.lit(None), "lower": f"lower({value})", "upper": f"upper({value})",
        "spaces": d.join("'  '", value, "' '"), "tab": d.join("chr(9)", value, "chr(9)"),
    }
    return _cases(d.draw(f"{name} dirt", CODE_DRAWS), [kinds[k] for k in CODE_DIRT], value)


def value_sql(d: Dialect) -> dict[str, str]:
    """Values that the columns' dirt refers to more than once, over (k, cu, c_name, na, r_name, cents, copy)."""
    year, month, day = (d.draw("year", 6), d.draw("month", 12), d.draw("day", 28))
    y, m, dd = f"(2020 + {year})", d.digits(f"1 + {month}", 2), d.digits(f"1 + {day}", 2)
    uk, us = d.join(dd, "'/'", m, "'/'", d.chars(y)), d.join(m, "'/'", dd, "'/'", d.chars(y))
    dashed = d.join(dd, "'-'", d.pick(MONTHS, month), "'-'", d.digits(f"{y} % 100", 2))
    kind = d.draw("date kind", 12)
    out = {
        "v_date": (
            f"CASE WHEN {kind} < 4 THEN {uk} WHEN {kind} < 8 THEN {us} WHEN {kind} < 11 THEN {dashed} "
            f"ELSE {d.pick(BAD_DATES, d.draw('bad date', len(BAD_DATES)))} END"
        ),
        "v_region": "r_name",
        "v_city": d.join("'City-on-'", d.chars("na")),
        "glass_cents": d.whole(f"cents * (30 + {d.draw('glass share', 81)})", "100"),
        "v_domain": d.pick(EMAIL_REPAIR_DOMAINS, d.draw("domain", len(EMAIL_REPAIR_DOMAINS))),
        "tech": f"(1000 + {d.draw('technician', 550)})",
    }
    for column in [*MAPPED_COLUMNS, "vehicle_brand", "vehicle_model"]:
        pool = code_pool(column)
        out[f"v_{column}"] = d.pick(pool, d.draw(f"{column} value", len(pool)))
    return out


def column_sql(d: Dialect, repeat_customers: bool = False, vary_technicians: bool = False, clashing_garages: bool = False) -> dict[str, str]:
    """Each raw column over those and the values of :func:`value_sql`."""

    def money(c: str) -> str:
        return d.join(d.chars(d.whole(c, "100")), "'.'", d.digits(f"({c}) % 100", 2))

    def paid(name: str, c: str) -> str:
        plain = money(c)
        thousands = d.join(
            d.chars(d.whole(c, "100000")), "','", d.digits(f"{d.whole(c, '100')} % 1000", 3), "'.'",
            d.digits(f"({c}) % 100", 2),
        )
        kinds = [
            "'unknown'", d.lit(NA_TOKEN), d.lit(None), d.join(plain, "' GBP'"), d.join("'£'", plain),
            f"CASE WHEN ({c}) >= 100000 THEN {thousands} ELSE {plain} END", d.join(plain, "'37'"),
            d.join("'-'", plain), "'1.2.3'",
            f"CASE WHEN k % 5 = 0 THEN rpad('9', 330, '9') ELSE rpad('9', 32, '0') END",
        ]
        return _cases(d.draw(f"{name} kind", 24), kinds, plain)

    date = _cases(d.draw("date pad", 9), [d.join("' '", "v_date"), d.join("v_date", "' '"),
                                          d.join("chr(9)", "v_date")], "v_date")
    titles = [f"{t.title() if i % 2 else t.lower()} " for i, t in enumerate(NAME_PREFIXES)] + ["Sir ", "MR. ", " ", ""]
    first = d.pick(FIRST_NAMES, d.draw("first name", len(FIRST_NAMES)))
    surname = _cases(d.draw("surname", 5), ["''"], d.join("' '", "c_name"))
    name = d.join(d.pick(titles, d.draw("title", len(titles))), first, f"({surname})")

    user = d.join("'u'", d.chars("cu"))
    domain = "v_domain"
    email = _cases(d.draw("email kind", 12), [
        d.join(user, domain), d.join(user, domain), f"upper({d.join(user, domain)})",
        f"upper({d.join(user, chr(39) + '@' + chr(39), domain)})", d.join("' '", user, "'@'", domain, "' '"),
        "'nonsense'", d.lit(NA_TOKEN), d.lit(None),
    ], d.join(user, "'@'", domain))

    def mobile(kind: str, number: str) -> str:
        nine = d.digits(number, 9)
        spaced = d.join("'07'", f"substr({nine}, 1, 3)", "' '", f"substr({nine}, 4, 6)")
        kinds = [d.lit(NA_TOKEN), d.join("'+44 7'", nine), spaced, d.join("'447'", nine), "'12345'", d.lit(None)]
        return _cases(d.draw(kind, 14), kinds, d.join("'07'", nine))

    outward = d.join("'M'", d.chars("na"))
    postcode = _cases(d.draw("postcode kind", 14), [
        d.lit(NA_TOKEN), "'sw1a   1aa'", outward, d.join("' m'", d.chars("na"), "' 1ae '"), "''", d.lit(None),
    ], d.join(outward, "' 1AE'"))

    garage, town = d.join("'Garage '", d.chars(d.draw("garage", 20)), "' Autoworks'"), "v_city"
    if clashing_garages:  # 'Plaza-City' in 'on-7' and 'Plaza' in 'City-on-7'
        garage = _cases("(k % 50)", ["'Plaza-City'", "'Plaza'"], garage)
        town = f"CASE WHEN k % 50 = 0 THEN {d.join(chr(39) + 'on-' + chr(39), d.chars('na'))} ELSE v_city END"
    tech_number = f"tech * 10 + {d.draw('technician phone', 2)}" if vary_technicians else "tech"
    out = {
        "job_id": f"CASE WHEN {d.draw('no job', 331)} = 0 THEN NULL ELSE CAST(100000 + k AS BIGINT) END",
        "repair_date": date,
        "region": _dirty(d, "region", "v_region"),
        "city": _dirty(d, "city", town),
        "garage_name": garage,
        "repair_cost": paid("repair cost", "cents"),
        "glass_cost": paid("glass cost", "glass_cents"),
        "profit": d.lit(None),
        "customer_rating": d.pick(RATINGS, d.draw("rating", len(RATINGS))),
        "customer_name": name,
        "customer_email": email,
        "customer_mobile": mobile("customer mobile", "cu"),
        "customer_postcode": postcode,
        "insurance_claimed": d.pick(BOOLEANS, d.draw("insurance", len(BOOLEANS))),
        "technician_id": f"CASE WHEN {d.draw('no technician', 29)} = 0 THEN NULL ELSE CAST(tech AS BIGINT) END",
        "technician_name": d.join("'Tech '", d.chars("tech")),
        "technician_mobile": d.join("'07'", d.digits(tech_number, 9)),
        "customer_id": (
            f"CASE WHEN {d.draw('no customer', 31)} = 0 THEN NULL "
            f"ELSE CAST(1000 + {'cu' if repeat_customers else 'k'} AS BIGINT) END"
        ),
        "vehicle_age_in_years": f"CAST({d.draw('age', 21)} AS INT)",
        "job_duration_in_hours": (
            f"CAST(10 + {d.draw('duration', 41)} + CASE WHEN k % 100 = 9 THEN 10 * copy ELSE 0 END AS DOUBLE) / 10"
        ),
    }
    for column in [*MAPPED_COLUMNS, "vehicle_brand", "vehicle_model"]:
        out[column] = _dirty(d, column, f"v_{column}")
    return out


COPIES = "CASE WHEN k % 100 IN (7, 9) THEN 2 ELSE 1 END"

# Input contract: only these columns of the driver tables are read.
_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    # nation and region are tiny: the planner broadcasts them by its size threshold.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    # orders and customer both grow with the data: shuffle both on the customer
    # key (AQE splits a hot customer). The per-row column building then runs in
    # the post-shuffle tasks, in parallel, whatever the input file layout.
    joined = orders.join(cust.hint("merge"), orders.o_custkey == cust.c_custkey)
    return joined.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cu"),
        "c_name",
        F.col("n_nationkey").alias("na"),
        "r_name",
        (F.round(F.col("o_totalprice") * 100).cast("bigint") % 240000 + 10000).alias("cents"),
    )


def dirty_repairs(
    spark: SparkSession, sf_dir: str, repeat_customers: bool = False, vary_technicians: bool = False, clashing_garages: bool = False
) -> DataFrame:
    """The raw repairs table (30 columns, RAW_SCHEMA order) for one scale factor."""
    tune_for_wide_rows(spark)
    base = _joined_orders(spark, sf_dir)
    copied = base.select("*", F.explode(F.expr(f"sequence(0, {COPIES} - 1)")).alias("copy"))
    copied = copied.select("*", *[F.expr(e).alias(c) for c, e in value_sql(SPARK).items()])
    sql = column_sql(SPARK, repeat_customers, vary_technicians, clashing_garages)
    return copied.select(*[F.expr(sql[c]).alias(c) for c in RAW_COLUMNS])


def recipe_sql(repeat_customers: bool = False, vary_technicians: bool = False, clashing_garages: bool = False) -> str:
    """The same rows in DuckDB SQL."""
    sql = column_sql(DUCKDB, repeat_customers, vary_technicians, clashing_garages)
    columns = ",\n  ".join(f"{sql[c]} AS {c}" for c in RAW_COLUMNS)
    values = ", ".join(f"{e} AS {c}" for c, e in value_sql(DUCKDB).items())
    return f"""SELECT {columns} FROM (SELECT *, {values} FROM (
  SELECT *, unnest(range({COPIES})) AS copy FROM (
    SELECT o_orderkey AS k, o_custkey AS cu, c_name, n_nationkey AS na, r_name,
           CAST(round(o_totalprice * 100) AS BIGINT) % 240000 + 10000 AS cents
    FROM orders, customer, nation, region
    WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey)))"""
