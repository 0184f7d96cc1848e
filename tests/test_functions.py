"""Unit tables for the column expressions (E-01 … E-21), with the edge cases."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from glazework import constants as K
from glazework import functions as G
from tests.conftest import column_values


def check(spark, table, fn, dtype="string"):
    inputs = [i for i, _ in table]
    expected = [e for _, e in table]
    assert column_values(spark, inputs, fn, dtype) == expected


def test_initcap_words(spark):
    check(spark, [
        ("city-on-3", "City-On-3"),
        ("T-ROC", "T-Roc"),
        ("lion's city", "Lion's City"),
        ("wind_screen", "Wind_Screen"),
        ("hydrophobic-coated", "Hydrophobic-Coated"),
        ("a  b", "A  B"),
        ("x--y", "X--Y"),
        ("3rd street", "3rd Street"),
        ("XC40", "Xc40"),
        ("café olé", "Café Olé"),
        ("a/b.c,d", "A/B.C,D"),
        ("", ""),
        (None, None),
    ], G.initcap_words)


def test_trim_ws_is_the_listed_trim_and_skips_clean_ends(spark):
    ends = ["", "a", "!", "~", "é", "\x7f", "\x00", "\x1f", "\U0001f600", "日", *K.TRIM_WHITESPACE]
    table = spark.createDataFrame([(None,), *[(x + m + y,) for x in ends for y in ends for m in ("", "a b", " é ")]], "x string")
    listed = F.trim("x", F.lit(K.TRIM_WHITESPACE))
    got = table.select("x", G.trim_ws(F.col("x")).alias("got"), listed.alias("want"))
    assert got.count() == 1 + 3 * len(ends) ** 2
    assert got.where("NOT (got <=> want)").collect() == []
    plan = got.select("got")._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan  # the list is looked up only where an end may need it


def test_clean_region_uses_lookup_only_when_missing(spark):
    df = spark.createDataFrame(
        [(0, "N/A", "africa"), (1, " asia ", None), (2, None, " EUROPE "), (3, "", "x"), (4, "n/a", "x"),
         (5, None, None), (6, "MIDDLE EAST", "y")],
        "i int, r string, l string",
    )
    out = [r[0] for r in df.orderBy("i").select(G.clean_region(F.col("r"), F.col("l"))).collect()]
    # empty string is not NULL (kept, not back-filled); the N/A test is case-sensitive
    assert out == ["Africa", "Asia", "Europe", "", "N/A", None, "Middle East"]


def test_clean_city(spark):
    check(spark, [(" N/A ", None), ("CITY-ON-2", "City-On-2"), ("City-On-2", "City-On-2"), (None, None),
                  ("\t leeds\u3000", "Leeds"), ("\u00a0N/A\n", None)], G.clean_city)


def test_vehicle_brand_and_model(spark):
    check(spark, [(" bmw ", "BMW"), ("n/a", None), ("KTM", "Ktm"), ("land rover", "Land Rover"),
                  ("mercedes-benz", "Mercedes-Benz"), (None, None)], G.clean_vehicle_brand)
    check(spark, [("r 1250 gs", "R 1250 GS"), ("XC40", "Xc40"), ("T-ROC", "T-Roc"), ("N/A", None),
                  ("LION'S CITY", "Lion's City"), (None, None)], G.clean_vehicle_model)


def test_clean_postcode(spark):
    check(spark, [("sw1a   1aa", "SW1A 1AA"), (" n/a ", None), ("", None), (None, None), ("M1 1AE", "M1 1AE"),
                  ("m1", "M1")], G.clean_postcode)


def test_clean_email(spark):
    check(spark, [
        (" User@Example.COM ", "user@example.com"),
        ("\tUser@Example.COM\u00a0", "user@example.com"),   # TRIM removes all Unicode whitespace
        ("u1gmail.com", "u1@gmail.com"),
        (" u1gmail.com", "u1@gmail.com"),        # raw ends with the domain: repaired after trim
        ("u1gmail.com ", None),                   # raw does not end with it: not repaired
        ("u1hotmail.co.uk", "u1@hotmail.co.uk"),
        ("u1yahoo.com", "u1@yahoo.com"),
        ("U1EXAMPLE.NET", None),                  # the raw test is case-sensitive
        ("gmail.comgmail.com", "@gmail.com@gmail.com"),  # every occurrence gets an '@'
        ("a@b", None),
        ("nonsense", None),
        (None, None),
    ], G.clean_email)


def test_uk_mobile(spark):
    check(spark, [
        ("07123 456789", "+447123456789"),
        ("+44 7123456789", "+447123456789"),
        ("+44 07123456789", None),
        ("+447123456789", "+447123456789"),
        ("0712345678", None),
        ("N/A", None),
        (None, None),
    ], G.uk_mobile)


def test_parse_full_name(spark):
    table = [
        ("Mr John Smith", ("Mr", "John", "Smith")),
        ("dr Li", ("Dr", "Li", None)),
        ("Mr", ("Mr", "", None)),
        ("Mr  John", ("Mr", "", "John")),
        (" Mary Jane Doe ", (None, "Mary", "Jane Doe")),
        ("PROF x y z", ("Prof", "x", "y z")),
        ("mrs. smith", (None, "mrs.", "smith")),
        ("MISS  a  b", ("Miss", "", "a  b")),
        ("", (None, "", None)),
        (None, (None, None, None)),
    ]
    out = column_values(spark, [i for i, _ in table], G.parse_full_name)
    assert [tuple(r) for r in out] == [e for _, e in table]


def test_parse_repair_date(spark):
    check(spark, [
        ("05-Mar-21", dt.date(2021, 3, 5)),
        (" 03/04/2021", dt.date(2021, 4, 3)),         # padding is ignored
        ("03/04/2021 ", dt.date(2021, 4, 3)),
        ("\t03-Jan-21\u00a0", dt.date(2021, 1, 3)),
        ("05-MAR-21", dt.date(2021, 3, 5)),
        ("13/05/2021", dt.date(2021, 5, 13)),
        ("05/13/2021", dt.date(2021, 5, 13)),
        ("03/05/2021", dt.date(2021, 5, 3)),      # ambiguous: day first, by design
        ("5/5/2021", dt.date(2021, 5, 5)),
        ("31/02/2021", None),
        ("05-Mar-75", dt.date(1975, 3, 5)),
        ("05-Mar-68", dt.date(2068, 3, 5)),
        ("2021-03-05", None),
        ("20/11/74", dt.date(74, 11, 20)),        # %Y reads the digits given: year 74, outside the calendar
        ("05/06/00", None),                       # year 0 is no date
        ("05/06/10000", None),
        ("bad", None),
        (None, None),
    ], G.parse_repair_date)


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 2),), (dt.date(2021, 12, 31),)], "d date")
    rows = df.select(G.date_key(F.col("d")), G.day_of_week(F.col("d")), G.day_name(F.col("d")),
                     G.month_name(F.col("d")), G.is_weekend(F.col("d"))).collect()
    assert [tuple(r) for r in rows] == [(20240602, 1, "Sunday", "June", True), (20211231, 6, "Friday", "December", False)]


def test_clean_currency_and_profit(spark):
    check(spark, [
        ("£1,234.56", 1234.56), ("1234.5637", 1234.56), ("12.345", 12.35), ("1.005", 1.01),
        ("100 GBP", 100.0), ("-5.00", 5.0), ("unknown", None), ("N/A", None), ("1.2.3", None),
        (".", None), ("", None), (None, None),
        ("9" * 330, None),                            # beyond a double: no amount, not infinity
        ("1" + "0" * 40, 1e40),
    ], G.clean_currency)
    df = spark.createDataFrame([(123.45, 67.89), (None, 1.0), (10.0, 10.01)], "a double, b double")
    out = [r[0] for r in df.select(G.money_difference(F.col("a"), F.col("b"))).collect()]
    assert out == [55.56, None, -0.01]


def test_clean_rating(spark):
    check(spark, [(" 5 ", 5), ("five", 5), ("ONE", 1), ("N/A", None), ("", None), ("0", 0), ("6", 6),
                  ("5.0", None), ("abc", None), (None, None)], G.clean_rating)


def test_clean_boolean(spark):
    check(spark, [("Yes", True), (" y ", True), ("TRUE", True), ("1", True), ("No", False), ("n", False),
                  ("0", False), ("False", False), ("", None), ("maybe", None), (None, None)], G.clean_boolean)


def test_prefixed_id(spark):
    assert column_values(spark, [5, None], lambda c: G.prefixed_id(K.JOB_ID_PREFIX, c), "bigint") == ["JOB5", None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None, True, 3)], "a string, b string, c boolean, d int")
    got = df.select(G.surrogate_key("a", "b", "c", "d")).first()[0]
    text = "-".join(["a", K.SURROGATE_KEY_NULL, "true", "3"])
    assert got == hashlib.md5(text.encode()).hexdigest()


def test_cleaning_is_idempotent(spark):
    """Clean values stay as they are when cleaned again (E-03, E-07, E-09)."""
    check(spark, [("Stoke-On-Trent", "Stoke-On-Trent"), ("Leeds", "Leeds")], G.clean_city)
    check(spark, [("SW1A 1AA", "SW1A 1AA")], G.clean_postcode)
    check(spark, [("+447000000123", "+447000000123")], G.uk_mobile)
