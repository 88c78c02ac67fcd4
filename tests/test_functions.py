"""Scalar semantics: decimal division (Q-04), pct change (Q-01), rounding
casts (Q-11), null tokens (Q-12), prefix strip (F-14), file-name month (Q-18)."""

from decimal import Decimal

from pyspark.sql import functions as F

from lodgeflow.functions.numeric import pct6, pct_change, ratio6, rounding_int
from lodgeflow.functions.text import month_from_file_name, null_tokens_to_null, strip_code_prefix


def test_ratio_rounds_to_six_digits_before_times_100(spark):
    r = spark.range(1).select(ratio6(F.lit(1481), F.lit(1485)).alias("r"),
                              pct6(F.lit(1481), F.lit(1485)).alias("p")).first()
    assert r.r == Decimal("0.997306")
    assert r.p == Decimal("99.730600")
    assert spark.range(1).select(ratio6(F.lit(1), F.lit(2_000_000)).alias("x")).first().x == Decimal("0.000001")


def test_pct_change_literal_minus_one_and_nullif(spark):
    row = spark.range(1).select(
        pct_change(F.lit(5), F.lit(2) - 1).alias("a"),      # lag 2 -> base 1
        pct_change(F.lit(5), F.lit(1) - 1).alias("b"),      # lag 1 -> base 0 -> NULL
        pct_change(F.lit(5), F.lit(None).cast("bigint")).alias("c")).first()
    assert row.a == Decimal("400.000000")
    assert row.b is None and row.c is None


def test_rounding_int(spark):
    df = spark.createDataFrame([("4.6",), ("2.5",), ("-2.5",), (" 7 ",), ("abc",), (None,)], "s string")
    got = [r.v for r in df.select(rounding_int("s").alias("v")).collect()]
    assert got == [5, 3, -3, 7, None, None]


def test_null_tokens(spark):
    df = spark.createDataFrame([("\\N",), ("NULL",), ("NUL",), ("",), ("null",), ("x",)], "s string")
    got = [r.v for r in df.select(null_tokens_to_null("s").alias("v")).collect()]
    assert got == [None, None, None, None, "null", "x"]


def test_strip_code_prefix(spark):
    df = spark.createDataFrame([("LGA10050",), ("LGA007",), ("LGAx",)], "s string")
    got = [r.v for r in df.select(strip_code_prefix("s").alias("v")).collect()]
    assert got == ["10050", "7", None]


def test_month_from_file_name(spark):
    df = spark.createDataFrame([("s3a://b/raw/05_2020.csv",), ("/x/12_2021_extra.csv",),
                                ("/x/13_2020.csv",)], "p string")
    got = [r.v for r in df.select(month_from_file_name("p").alias("v")).collect()]
    assert [str(v) if v else None for v in got] == ["2020-05-01", "2021-12-01", None]


def test_boolean_text(spark):
    from lodgeflow.plans.staging import _bool
    df = spark.createDataFrame([("t",), ("FALSE",), (" yes ",), ("On",), ("off",), ("0",), ("maybe",), (None,)], "b string")
    got = [r.v for r in df.select(_bool("b").alias("v")).collect()]
    assert got == [True, False, True, True, False, False, None, None]


def test_ratio6_agrees_with_exact_decimal_and_the_oracle(spark):
    """Spark's DECIMAL(38,0) division, exact half-up arithmetic and the SQL
    oracle's integer emulation give the same six-digit result."""
    import random
    from decimal import ROUND_HALF_UP

    import duckdb

    from lodgeflow.plans.oracle_sql import _r6

    rnd = random.Random(7)
    pairs = [(rnd.randint(-10**9, 10**9), rnd.choice([-1, 1]) * rnd.randint(1, 10**6))
             for _ in range(2000)]
    pairs += [(1, 2_000_000), (-1, 2_000_000), (3, 2_000_000), (1, 8), (-5, 16), (1481, 1485)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {(r.a, r.b): r.q for r in df.select("a", "b", ratio6("a", "b").alias("q")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a BIGINT, b BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    oracle = {(a, b): m for a, b, m in con.execute(f"SELECT a, b, {_r6('a', 'b')} FROM t").fetchall()}
    for a, b in pairs:
        exact = (Decimal(a) / Decimal(b)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert got[(a, b)] == exact, (a, b)
        assert Decimal(int(oracle[(a, b)])) / Decimal(10**6) == exact, (a, b)
