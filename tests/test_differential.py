"""Randomised differential tests: each cleaning expression in Spark against the
independent DuckDB formulation of the oracle, on generated dirty strings."""

import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import duckdb_sql as D
from glazework import constants as K
from glazework import functions as G

N = 400
SEED_OFFSET = int(os.environ.get("DIFF_SEED", "0"))


def _rand_text(rng, alphabet, max_len=14):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len)))


def _pad(rng, s):
    ws = ["", " ", "  ", "\t", "\u00a0", " \u3000", "\n"]
    return rng.choice(ws) + s + rng.choice(ws)


def _case(rng, s):
    return rng.choice([str.lower, str.upper, str.title, lambda x: x])(s)


def gen_words(rng):
    alphabet = "abcXYZ éü'" + K.INITCAP_DELIMITER_CHARS + "0123456789"
    return [_rand_text(rng, alphabet) for _ in range(N)]


def gen_names(rng):
    titles = ["Mr", "mr", "MRS", "Miss", "ms", "Dr", "prof", "Prof.", "Sir", ""]
    parts = ["Ann", "bob", "MARY", "Jane", "o'neil", "li", "", "x-y"]
    out = []
    for _ in range(N):
        words = [rng.choice(titles)] + [rng.choice(parts) for _ in range(rng.randint(0, 3))]
        out.append(_pad(rng, rng.choice([" ", "  "]).join(words)))
    return out


def gen_emails(rng):
    users = ["u1", "John.Doe", "a_b", "x+y", "", "Z9"]
    out = []
    for _ in range(N):
        dom = rng.choice(K.EMAIL_REPAIR_DOMAINS + ["mail.co", "x.y.zz", "gmail", "b"])
        at = rng.choice(["@", "", "", "@@"])
        s = rng.choice(users) + at + _case(rng, dom) + rng.choice(["", "", dom])
        out.append(_pad(rng, s) if rng.random() < 0.3 else s)
    return out


def gen_mobiles(rng):
    out = []
    for _ in range(N):
        digits = "".join(rng.choice("0123456789") for _ in range(9))
        s = rng.choice(["07", "+44 7", "+44 07", "447", "7", "0044 7", "N/A"]) + digits[: rng.randint(7, 9)]
        out.append(rng.choice(["", " ", "-", "("]) + s if rng.random() < 0.3 else s)
    return out


def gen_postcodes(rng):
    return [_pad(rng, _case(rng, rng.choice(["sw1a", "M1", "n/a", "", "EC1A"]) + rng.choice(["", " ", "   ", "\t"])
                       + rng.choice(["1aa", "2BB", ""]))) for _ in range(N)]


def gen_costs(rng):
    out = []
    for _ in range(N):
        num = f"{rng.randint(0, 99999)}.{rng.randint(0, 9999):0{rng.choice([1, 2, 3, 4])}d}"
        s = rng.choice(["", "£", "GBP ", "-", "$"]) + rng.choice([num, num.replace(".", ","), "1.2.3", ".", "unknown", "N/A", "5", "1,234.5", "9" * 330, "8" * 35]) + rng.choice(["", " GBP", "p"])
        out.append(s)
    return out


def gen_ratings(rng):
    return [_pad(rng, _case(rng, rng.choice(["1", "5", "0", "6", "five", "one", "n/a", "", "5.0", "+3", "-2", "abc", "10", "99999999999999999999"]))) for _ in range(N)]


def gen_bools(rng):
    return [_pad(rng, _case(rng, rng.choice(["yes", "y", "true", "1", "no", "n", "false", "0", "", "maybe", "t"]))) for _ in range(N)]


def gen_dates(rng):
    mons = ["Jan", "feb", "MAR", "Sep", "Sept", "Foo"]
    out = []
    for _ in range(N):
        d, m, y = rng.randint(0, 33), rng.randint(0, 14), rng.randint(1965, 2031)
        out.append(_pad(rng, "") + rng.choice([
            f"{d:02d}/{m:02d}/{y}", f"{m}/{d}/{y}", f"{d}-{rng.choice(mons)}-{y % 100:02d}", f"{d}/{m}",
            f"{y}-{m:02d}-{d:02d}", "bad", "", f"{d:02d}/{m:02d}/{y % 100:02d}",
        ]) + _pad(rng, ""))
    return out


CASES = [
    ("initcap", gen_words, G.initcap_words, D.initcap),
    ("name_prefix", gen_names, lambda c: G.parse_full_name(c)["prefix"], lambda x: D.name_parts(x)[0]),
    ("name_first", gen_names, lambda c: G.parse_full_name(c)["first_name"], lambda x: D.name_parts(x)[1]),
    ("name_surname", gen_names, lambda c: G.parse_full_name(c)["surname"], lambda x: D.name_parts(x)[2]),
    ("email", gen_emails, G.clean_email, D.email),
    ("mobile", gen_mobiles, G.uk_mobile, D.mobile),
    ("postcode", gen_postcodes, G.clean_postcode, D.postcode),
    ("currency", gen_costs, G.clean_currency, D.money),
    ("rating", gen_ratings, G.clean_rating, D.rating),
    ("boolean", gen_bools, G.clean_boolean, D.boolean),
    ("date", gen_dates, G.parse_repair_date, D.parse_date),
    ("city", gen_words, G.clean_city, D.city),
    ("brand", gen_words, G.clean_vehicle_brand, D.brand),
]


@pytest.mark.parametrize("name,gen,spark_fn,sql_fn", CASES, ids=[c[0] for c in CASES])
def test_spark_matches_duckdb(spark, name, gen, spark_fn, sql_fn):
    rng = random.Random(zlib.crc32(name.encode()) + SEED_OFFSET)
    values = gen(rng) + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r["i"]: r["y"] for r in df.select("i", spark_fn(F.col("x")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = dict(con.execute(f"SELECT i, {sql_fn('x')} FROM t").fetchall())
    bad = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, bad[:5]


def gen_models(rng):
    pool = ["r 1250 gs", "R 1250 GS", " r 1250 gs ", "XC40", "t-roc", "Lion's City", "n/a", "N/A", ""]
    return gen_words(rng)[: N // 2] + [_pad(rng, _case(rng, rng.choice(pool))) for _ in range(N // 2)]


def _pairs_case(spark, name, left, right, spark_fn, sql_fn):
    values = list(zip(left, right)) + [(None, None), (None, "x"), ("x", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], "i int, a string, b string")
    got = {r["i"]: r["y"] for r in df.select("i", spark_fn(F.col("a"), F.col("b")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(values)])
    want = dict(con.execute(f"SELECT i, {sql_fn('a', 'b')} FROM t").fetchall())
    bad = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not bad, (name, bad[:5])


def test_model_matches_duckdb(spark):
    rng = random.Random(zlib.crc32(b"model") + SEED_OFFSET)
    values = gen_models(rng) + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r["i"]: r["y"] for r in df.select("i", G.clean_vehicle_model(F.col("x")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = dict(con.execute(f"SELECT i, {D.model('x')} FROM t").fetchall())
    assert all(got[i] == want[i] for i in got), [(values[i], got[i], want[i]) for i in got if got[i] != want[i]][:5]


def test_region_matches_duckdb(spark):
    rng = random.Random(zlib.crc32(b"region") + SEED_OFFSET)
    regions = [rng.choice(["N/A", "n/a", "", " ", None, "north west", " SOUTH-EAST ", "x_y"]) for _ in range(N)]
    looked = [rng.choice([None, "", " Wales ", "north-east", "N/A"]) for _ in range(N)]
    _pairs_case(spark, "region", regions, looked, G.clean_region, D.region)


def test_profit_matches_duckdb(spark):
    rng = random.Random(zlib.crc32(b"profit") + SEED_OFFSET)
    _pairs_case(spark, "profit", gen_costs(rng), gen_costs(rng),
                lambda a, b: G.money_difference(G.clean_currency(a), G.clean_currency(b)), D.profit)
