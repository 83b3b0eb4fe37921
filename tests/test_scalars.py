"""Column functions at their edges."""

import base64
import random
from decimal import Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import day
from tidemart.functions.scalars import (
    as_text, date_parts, days_before, decode_decimal, lenient, lenient_date, lenient_int, normalise, parse_ts, strict, year_month,
)


@pytest.mark.parametrize("precision,scale,bits", [(18, 0, 59), (18, 2, 59), (18, 18, 59), (9, 4, 29), (38, 0, 125), (38, 2, 125), (38, 10, 125)])
def test_base64_decimals(spark, precision, scale, bits):
    rng = random.Random(precision + scale)
    values = [0, 1, -1, 127, 128, -128, -129, 12050, 10**(precision - 1), -10**(precision - 1), 10**precision - 1, 1 - 10**precision]
    values += [rng.randint(-2**b, 2**b) for b in range(1, bits) for _ in range(3)]
    rows = [(base64.b64encode(v.to_bytes((v.bit_length() + 8) // 8, "big", signed=True)).decode(), str(v)) for v in values]
    df = spark.createDataFrame(rows, "coded string, v string").select("v", decode_decimal("coded", precision, scale).alias("d"))
    with localcontext() as ctx:
        ctx.prec = 60
        for r in df.collect():
            assert r.d == Decimal(r.v).scaleb(-scale), r


def test_base64_decimals_that_do_not_fit(spark):
    big = base64.b64encode((10**20).to_bytes(9, "big")).decode()
    df = spark.createDataFrame([("!!",), (None,), ("",), (big,)], "c string")
    for precision in (9, 18, 20):
        assert {r[0] for r in df.select(decode_decimal("c", precision, 2)).collect()} == {None}


def test_casts(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(lenient("v", "int")).collect()] == [5, None, None]
    texts = spark.createDataFrame([("5.7",), ("-3.",), (" 4 ",), ("1.2.3",), ("x.5",), ("1e3",), ("99999999999",)], "v string")
    assert [r[0] for r in texts.select(lenient_int("v")).collect()] == [5, -3, 4, None, None, None, None]
    with pytest.raises(PySparkException):
        df.select(strict("v", "int")).collect()
    ok = df.filter("v is null or v = '5'").select(strict("v", "int").alias("n"))
    assert [r.n for r in ok.collect()] == [5, None] and dict(ok.dtypes)["n"] == "int"


def test_strict_cast_fails_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            spark.createDataFrame([("x",)], "v string").select(strict("v", "int")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_dates_and_text(spark):
    df = spark.createDataFrame([("2026-02-28", "2026-03-01 10:00:00", "  MiXed ")], "d string, t string, s string")
    got = df.select(
        lenient_date("d").alias("d"), lenient_date(F.lit("2026-02-30")).alias("bad"), lenient_date(F.lit("2026")).alias("year"),
        F.hour(parse_ts("t", "yyyy-MM-dd HH:mm:ss")).alias("h"), F.hour(parse_ts(F.lit("2026-03-01T11:00:00"))).alias("iso"),
        parse_ts(F.lit("soon")).alias("never"), year_month(lenient_date("d")).alias("ym"), normalise("s").alias("s"),
        days_before("2026-03-01", 30).alias("before"), as_text(F.lit(b"abc")).alias("bytes"),
    ).first()
    assert tuple(got) == (day("2026-02-28"), None, None, 10, 11, None, "2026-02", "mixed", day("2026-01-30"), "abc")
    parts = df.select(*date_parts(lenient_date("d"))).first()
    assert tuple(parts) == (20260228, day("2026-02-28"), 2026, 1, 2, "February", 28)
