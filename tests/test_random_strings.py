"""Differential on random strings: every Spark cleaner against its DuckDB
counterpart from the oracle, over the characters the cleaners act on."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from paysift.functions import cleaners as C
from paysift.functions.casts import try_float, try_int_trunc, try_money
from paysift.functions.text import has_letter, range_bounds
from paysift.plans import oracle as O

ALPHABET = "aB1 0,;/(-+$€£~_<%.9yx"


@pytest.fixture(scope="module")
def strings():
    rnd = random.Random(7)
    vals = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    vals += [" - ", "-", "--", "(", ")", "1 y", "5 - 10 years", "1.5-2.5", "+", "<", "", " ", "12 34"]
    return vals


CASES = {
    "money_a": (lambda c: try_money(C.money_a(c)), lambda x: O.money(O.money_a(x))),
    "money_c_base": (lambda c: try_money(C.money_c_base(c)), lambda x: O.money(O.money_c_base(x))),
    "money_c_signing": (lambda c: try_money(C.money_c_signing(c)), lambda x: O.money(O.money_c_signing(x))),
    "money_c_annual": (lambda c: try_money(C.money_c_annual(c)), lambda x: O.money(O.money_c_annual(x))),
    "location_a": (C.location_a, O.location_a),
    "location_c": (C.location_c, O.location_c),
    "industry_b": (C.industry_b, O.industry_b),
    "gender_c": (C.gender_c, O.gender_c),
    "experience_c": (lambda c: try_float(C.experience_c(c)), lambda x: O.flt(O.exp_c(x))),
    "experience_a_lo": (lambda c: try_float(C.experience_a(c)[0]), lambda x: O.flt(O.part(O.exp_a(x), 0))),
    "experience_a_hi": (lambda c: try_float(C.experience_a(c)[1]), lambda x: O.flt(O.hi_or_lo(O.exp_a(x)))),
    "range_plus_lo": (lambda c: try_int_trunc(C.range_plus(c)[0]), lambda x: O.int_trunc(O.part(O.plus_range(x), 0))),
    "range_plus_hi": (lambda c: try_int_trunc(C.range_plus(c)[1]), lambda x: O.int_trunc(O.hi_or_lo(O.plus_range(x)))),
    "age_hi": (lambda c: try_int_trunc(range_bounds(c, fill_upper=False)[1]), lambda x: O.int_trunc(O.part(x, 1))),
    "vacation": (lambda c: try_int_trunc(C.vacation_text(c)), lambda x: O.int_trunc(f"replace({x}, '+', '')")),
    "letter": (has_letter, O.letter),
    "bonus_format": (lambda c: c.rlike("[A-Za-z%-]"), lambda x: f"regexp_matches({x}, '[A-Za-z%-]')"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_cleaner_matches_duckdb(spark, strings, name):
    spark_fn, duck_fn = CASES[name]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, x string")
    got = {r[0]: r[1] for r in df.select("i", spark_fn(F.col("x")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("create table t(i integer, x varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(strings)))
    want = dict(con.sql(f"select i, {duck_fn('x')} from t").fetchall())
    diff = [(strings[i], got[i], want[i]) for i in range(len(strings)) if got[i] != want[i]]
    assert not diff, diff[:5]


def test_location_b_matches_duckdb(spark, strings):
    rnd = random.Random(11)
    pairs = [(rnd.choice(strings), rnd.choice(strings)) for _ in range(2000)] + [("", ""), ("", "x"), ("y", "")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, city string, country string")
    got = {r[0]: r[1] for r in df.select("i", C.location_b("city", "country")).collect()}
    con = duckdb.connect()
    con.execute("create table t(i integer, city varchar, country varchar)")
    con.executemany("insert into t values (?, ?, ?)", [(i, a, b) for i, (a, b) in enumerate(pairs)])
    want = dict(con.sql(f"select i, {O.location_b('city', 'country')} from t").fetchall())
    assert {i: got[i] for i in got if got[i] != want[i]} == {}


def test_timestamp_parse_matches_duckdb(spark):
    from paysift.functions.casts import try_ts

    rnd = random.Random(5)

    def num(lo, hi, pad=False):
        v = str(rnd.randint(lo, hi))
        return v.zfill(2) if pad and rnd.random() < 0.5 else v

    vals = []
    for _ in range(3000):
        d = f"{num(0, 13, True)}/{num(0, 32, True)}/{rnd.choice([num(1990, 2030), num(10, 99), num(10000, 10020)])}"
        t = f"{num(0, 25, True)}:{num(0, 61).zfill(rnd.choice([1, 2, 2, 2]))}:{num(0, 61).zfill(2)}"
        vals.append(rnd.choice([f"{d} {t}", f"{d}  {t}", d, f"{d} {t[:-3]}", f"{d}T{t}", f" {d} {t}"]))
    vals += ["2/29/2020 1:00:00", "2/29/2019 1:00:00", "4/31/2019 1:00:00", "12/31/1999 23:59:59"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(vals)], "i int, x string")
    got = {r[0]: r[1] for r in df.select("i", try_ts("x").cast("timestamp_ntz")).collect()}
    con = duckdb.connect()
    con.execute("create table t(i integer, x varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(vals)))
    want = dict(con.sql(f"select i, {O.ts('x')} from t").fetchall())
    diff = [(vals[i], got[i], want[i]) for i in range(len(vals)) if got[i] != want[i]]
    assert not diff, diff[:5]
    assert sum(v is not None for v in got.values()) > 100
