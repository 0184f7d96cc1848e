"""Fixed values.

Everything in this module is a value that must stay exactly as written for the
published tables to come out right: token spellings, word lists, patterns,
formats, bounds and the allowed-value lists of the data tests. Keep them as
plain data; the logic lives in ``functions`` and ``operators``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the modelled warehouse; do not edit to make tests pass)
# ---------------------------------------------------------------------------

# TRIM removes leading and trailing whitespace: the Unicode White_Space
# characters U+0009..U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
TRIM_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# First and last printable ASCII character (no space), and what follows the last.
PRINTABLE_ASCII = ("!", "~")
AFTER_PRINTABLE_ASCII = "\x7f"

# Missing-value marker used by the source system.
NA_TOKEN = "N/A"

# Name titles recognised as a prefix (compared upper-case, no dots).
NAME_PREFIXES = ["MR", "MISS", "MS", "MRS", "DR", "PROF"]

# E-mail validity pattern (applied to the lower-cased, trimmed value).
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Domains whose missing '@' is repaired, in the order they are tried.
EMAIL_REPAIR_DOMAINS = [
    "gmail.com",
    "yahoo.co.uk",
    "yahoo.com",
    "hotmail.com",
    "hotmail.co.uk",
    "outlook.com",
    "example.com",
    "example.net",
    "example.org",
]

# UK mobile numbers, matched on the digits-only string:
# "07" + 9 digits (national) and "447" + 9 digits (international).
UK_MOBILE_NATIONAL = ("07", 11)          # (leading digits, total digits)
UK_MOBILE_INTERNATIONAL = ("447", 12)
UK_COUNTRY_PREFIX = "+44"

# Currency: every character outside this class is dropped before the cast.
CURRENCY_STRIP = r"[^0-9.]"
MONEY_SCALE = 2

# Ratings.
RATING_NULL_WORDS = ["n/a", ""]
RATING_WORDS = [("one", 1), ("five", 5)]

# Booleans (compared lower-case, trimmed).
BOOLEAN_TRUE_WORDS = ["yes", "y", "true", "1"]
BOOLEAN_FALSE_WORDS = ["no", "n", "false", "0"]

# Values kept verbatim instead of being title-cased.
BRAND_KEEP_UPPER = "BMW"
MODEL_KEEP_VERBATIM = "R 1250 GS"

# Repair-date formats, as (strftime form, Spark pattern).
DATE_FORMAT_DAY_MON_YY = ("%d-%b-%y", "d-MMM-yy")
DATE_FORMAT_US = ("%m/%d/%Y", "M/d/y")
DATE_FORMAT_UK = ("%d/%m/%Y", "d/M/y")
# Two-digit years 69..99 are 1969..1999, 00..68 are 2000..2068.
TWO_DIGIT_YEAR_PIVOT = 2069
# Range of a DATE; a parse outside it (year 0, 10000, negative) is no date.
DATE_MIN_YEAR = 1
DATE_MAX_YEAR = 9999

# Word delimiters for title-casing: whitespace plus these characters.
INITCAP_DELIMITER_CHARS = '[](){}/|\\<>!?@"^#$&~_,.:;*%+-'

# Surrogate keys: md5 over the '-'-joined string forms, NULL spelled as below.
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Prefixes of the business identifiers.
JOB_ID_PREFIX = "JOB"
TECHNICIAN_ID_PREFIX = "TECH"
CUSTOMER_ID_PREFIX = "CUST"

# Calendar dimension: daily, start inclusive, end exclusive.
DATE_SPINE_START = "2020-01-01"
DATE_SPINE_END_EXCLUSIVE = "2030-12-31"
WEEKEND_DAY_NAMES = ["Saturday", "Sunday"]

# Allowed clean values per mapped column (data tests "unmapped_values").
ALLOWED_VALUES = {
    "garage_type": ["Franchise", "Independent", "Mobile"],
    "vehicle_type": ["SUV", "Truck", "Motorcycle", "Bus", "Campervan", "Hatchback", "Estate", "Sedan", "Van"],
    "glass_type": ["OEM", "Acoustic", "Hydrophobic-Coated", "Tinted", "Heated", "Solar-Control", "Tempered", "Laminated", "Privacy"],
    "window_position": ["Windscreen", "Front Windshield", "Vent Glass", "Tailgate Glass", "Side Panel Glass", "Front Left Door", "Front Right Door", "Rear Window", "Quarter Glass", "Rear Left Door", "Rear Right Door", "Sunroof"],
    "damage_type": ["Chip", "Crack", "Scratch", "Shatter", "Other"],
    "repair_type": ["Reseal", "Repair", "Crack Repair", "Adas Calibration", "Chip Repair", "Replacement"],
    "weather_condition": ["Clear", "Rain", "Fog", "Snow", "Windy"],
    "traffic_level": ["Low", "Medium", "High", "Heavy"],
}

# Not-null data tests on staging, with their severity.
NOT_NULL_TESTS = [
    ("job_id", "error"),
    ("customer_id", "error"),
    ("technician_id", "error"),
    ("repair_date", "error"),
    ("customer_email", "warn"),
]

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Mapped (seeded) columns, in staging order of the joins.
MAPPED_COLUMNS = [
    "vehicle_type",
    "garage_type",
    "glass_type",
    "damage_type",
    "repair_type",
    "window_position",
    "weather_condition",
    "traffic_level",
]
