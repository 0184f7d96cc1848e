"""Text standardisation expressions (E-02 … E-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glazework import constants as K


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _delimiter_class() -> str:
    """Java regex character class of the title-casing word delimiters."""
    return "[\\s" + "".join("\\" + ch for ch in K.INITCAP_DELIMITER_CHARS) + "]"


_DELIM = _delimiter_class()


def initcap_words(col: Column) -> Column:
    """Title-case: first character of every word upper, the rest lower.

    A word starts after whitespace or any of the delimiter characters
    (hyphen, underscore, slash, dot, …), so ``T-ROC`` → ``T-Roc`` and
    ``wind_screen`` → ``Wind_Screen``; an apostrophe does not start a word.

    Spark's ``initcap`` starts words only after a space, so a space is put
    after every delimiter, ``initcap`` runs, and exactly that space is taken
    out again (a left-to-right scan pairs each delimiter with the space that
    follows it). Built-in string functions only, no arrays or lambdas.
    """
    spaced = F.regexp_replace(F.lower(col), f"({_DELIM})", "$1 ")
    return F.regexp_replace(F.initcap(spaced), f"({_DELIM}) ", "$1")


def trim_ws(col: Column) -> Column:
    """TRIM as the warehouse does it: all leading/trailing Unicode whitespace,
    not only spaces (Spark's one-argument ``trim`` removes spaces only).

    That trim looks up every end character in the list and copies the text, about 1 µs a call. Text whose
    first and last characters are printable ASCII has nothing to trim, which two comparisons tell.
    ``col`` is named several times, so it should be a plain column.
    """
    first, last = K.PRINTABLE_ASCII
    nothing = (col >= first) & (col < K.AFTER_PRINTABLE_ASCII) & F.substring(col, -1, 1).between(first, last)
    return F.when(nothing, col).otherwise(_trim_listed(col))


def _trim_listed(col: Column) -> Column:
    return F.trim(col, F.lit(K.TRIM_WHITESPACE))


def _na_to_null(col: Column) -> Column:
    """TRIM, then the N/A marker (case-sensitive) becomes NULL."""
    return F.nullif(trim_ws(col), F.lit(K.NA_TOKEN))


def clean_region(region: Column, looked_up_region: Column) -> Column:
    """E-02: own region unless missing/N/A, else the region looked up by city."""
    return _trim_listed(initcap_words(F.coalesce(_na_to_null(region), trim_ws(looked_up_region))))


def clean_city(city: Column) -> Column:
    """E-03: trimmed, N/A → NULL, title-cased."""
    return _trim_listed(initcap_words(_na_to_null(city)))


def clean_vehicle_brand(brand: Column) -> Column:
    """E-05: BMW stays upper-case, N/A → NULL, everything else title-cased."""
    up = F.upper(trim_ws(brand))
    return (
        F.when(up == K.BRAND_KEEP_UPPER, F.lit(K.BRAND_KEEP_UPPER))
        .when(up == K.NA_TOKEN, _null_str())
        .otherwise(initcap_words(trim_ws(brand)))
    )


def clean_vehicle_model(model: Column) -> Column:
    """E-06: N/A → NULL, one model kept verbatim, everything else title-cased."""
    up = F.upper(trim_ws(model))
    return (
        F.when(up == K.NA_TOKEN, _null_str())
        .when(up == K.MODEL_KEEP_VERBATIM, F.lit(K.MODEL_KEEP_VERBATIM))
        .otherwise(initcap_words(trim_ws(model)))
    )


def clean_postcode(postcode: Column) -> Column:
    """E-07: upper-case, trimmed, inner whitespace runs → one space; N/A or empty → NULL."""
    up = F.upper(trim_ws(postcode))
    return F.when(up.isin(K.NA_TOKEN, ""), _null_str()).otherwise(F.regexp_replace(up, r"\s+", " "))


def _java_anchored(pattern: str) -> str:
    # Java's '$' also matches before a final line terminator; '\z' is the
    # strict end of input, which is what the pattern means.
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def clean_email(email: Column) -> Column:
    """E-08: valid → lower-trimmed; a known domain missing its '@' → repaired; else NULL.

    The repair looks at the raw value (untrimmed, case-sensitive): it must
    contain no '@' and end with one of the domains, taken in list order. The
    '@' is then put before every occurrence of that domain in the
    lower-trimmed value: a plain string replace, which is what replacing the
    escaped-domain pattern with ``@`` + the match does, in a fraction of the
    generated code of one regex replace per domain.
    """
    lt = F.lower(trim_ws(email))
    domain = F.coalesce(*[F.when(email.endswith(d), F.lit(d)) for d in K.EMAIL_REPAIR_DOMAINS])
    repaired = F.when(~email.contains("@"), F.replace(lt, domain, F.concat(F.lit("@"), domain)))
    return F.when(lt.rlike(_java_anchored(K.EMAIL_PATTERN)), lt).otherwise(repaired)


def uk_mobile(mobile: Column) -> Column:
    """E-09: digits only; 07 + 9 digits → +447…; 447 + 9 digits → +447…; else NULL.

    On a digits-only string "07 followed by 9 digits" is just "starts with 07,
    11 long", so the tests need no regex.
    """
    digits = F.regexp_replace(mobile, "[^0-9]", "")
    n = F.length(digits)
    (nat, nat_len), (intl, intl_len) = K.UK_MOBILE_NATIONAL, K.UK_MOBILE_INTERNATIONAL
    return (
        F.when((n == nat_len) & digits.startswith(nat), F.concat(F.lit(K.UK_COUNTRY_PREFIX), F.substring(digits, 2, 1 << 30)))
        .when((n == intl_len) & digits.startswith(intl), F.concat(F.lit("+"), digits))
        .otherwise(_null_str())
    )


def _before_space(s: Column) -> Column:
    """Text before the first space (all of it when there is none)."""
    return F.substring_index(s, " ", 1)


def _after_space(s: Column, nth: int = 1) -> Column:
    """Text after the nth space ('' when there are fewer: the start then lies
    past the end of the string)."""
    return s.substr(F.length(F.substring_index(s, " ", nth)) + 2, F.length(s))


def parse_full_name(name: Column) -> Column:
    """E-10 / R-13: STRUCT(prefix, first_name, surname) from a full name.

    The first space-separated piece is a prefix when it is a known title
    (INITCAPed). The remainder (the other pieces, or the whole trimmed name
    when there is no prefix) gives the first name (its first piece) and the
    surname (the other pieces, space-joined; empty → NULL). Splitting on ' '
    and joining the tail with ' ' is the text after the first space, so this
    is computed with plain string functions; repeated spaces are kept, and a
    bare title gives first_name '' (not NULL).
    """
    trimmed = trim_ws(name)
    head = _before_space(trimmed)
    has_prefix = F.upper(head).isin(K.NAME_PREFIXES)
    # A title is letters only, so Spark's own initcap already title-cases it.
    prefix = F.when(has_prefix, F.initcap(head)).otherwise(_null_str())
    remainder = F.when(has_prefix, _after_space(trimmed)).otherwise(trimmed)
    first_name = _before_space(remainder)
    # the remainder's own tail: after the second space with a title, else the first
    tail = F.when(has_prefix, _after_space(trimmed, 2)).otherwise(_after_space(trimmed))
    surname = F.nullif(tail, F.lit(""))
    return F.struct(prefix.alias("prefix"), first_name.alias("first_name"), surname.alias("surname"))
