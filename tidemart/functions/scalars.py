"""Scalar column functions. Lenient ones give NULL on bad input; strict ones fail the query."""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp, NULL when it does not parse. Without a pattern: ISO.

    The usual pattern goes by shape check and cast, which is several times faster than a formatter.
    """
    text = _c(col)
    if pattern == TIMESTAMP_PATTERN:
        return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def lenient(col: Column | str, type_name: str) -> Column:
    """Cast that gives NULL for values that do not fit."""
    return _c(col).try_cast(type_name)


def lenient_int(col: Column | str) -> Column:
    """Text to int; white space around it and a decimal part are cut off, anything else that is no integer gives NULL.

    A decimal part without digits before it is 0.
    """
    text = F.regexp_replace(_c(col).cast("string"), r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$", "")
    whole = F.regexp_extract(text, r"^([+-]?\d*)(\.\d*)?$", 1)
    return F.when(whole.rlike(r"\d"), whole.try_cast("int")).when(text.rlike(r"^[+-]?\.\d*$"), F.lit(0))


def strict(col: Column | str, type_name: str) -> Column:
    """Cast that fails the query on a value that does not fit, whatever the ANSI setting.

    `try_cast` plus an explicit error: a plain cast would give NULL when ANSI mode is off.
    """
    value = _c(col)
    cast = value.try_cast(type_name)
    message = F.concat(F.lit("cannot cast '"), value.cast("string"), F.lit(f"' to {type_name}"))
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(F.raise_error(message).cast(type_name))


def lenient_date(col: Column | str) -> Column:
    """`yyyy-MM-dd` text to date, NULL when it does not parse."""
    text = _c(col)
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date"))


def to_day(col: Column | str) -> Column:
    return F.to_date(_c(col))


def year_month(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def normalise(col: Column | str) -> Column:
    return F.lower(F.trim(_c(col)))


def as_text(col: Column | str) -> Column:
    return _c(col).cast("string")


def days_before(as_of: date | str | Column | None, days: int) -> Column:
    """`as_of` minus `days`; today when `as_of` is None."""
    start = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.date_sub(start, days)


def date_key(col: Column | str) -> Column:
    """Integer `yyyymmdd`."""
    day = _c(col)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def date_parts(col: Column | str) -> list[Column]:
    """Calendar columns of a date dimension row."""
    day = _c(col)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
    ]


def decode_decimal(col: Column | str, precision: int, scale: int) -> Column:
    """Base64 text holding a big-endian two's-complement unscaled integer, as a decimal.

    NULL when the text is not base64 or the value does not fit. Up to 18 digits come from 8 bytes,
    which `conv` reads at once; more digits are read in limbs from up to 16 bytes.
    """
    raw = F.hex(F.try_to_binary(_c(col), F.lit("base64")))
    negative = F.substring(raw, 1, 1) >= "8"
    if precision <= 18:
        filled = F.lpad(raw, F.lit(16), F.when(negative, "F").otherwise("0"))
        whole = F.conv(filled, 16, -10).try_cast(f"decimal({precision},0)")
        unscaled = F.when(F.length(raw).between(2, 16), whole)
        return (unscaled * F.lit(Decimal(1).scaleb(-scale))).try_cast(f"decimal({precision},{scale})")

    # A negative number is -(~x + 1): flip its digits, then read both signs as a magnitude.
    digits = F.lpad(F.when(negative, F.translate(raw, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(raw), 32, "0")

    def limb(first: int, width: int) -> Column:
        return F.conv(F.substring(digits, first, width), 16, 10).cast("decimal(38,0)")

    high = F.try_multiply(limb(1, 4), F.lit(str(2**112)).cast("decimal(38,0)"))
    middle = limb(5, 14) * F.lit(str(2**56)).cast("decimal(38,0)")
    low = limb(19, 14) + F.when(negative, 1).otherwise(0).cast("decimal(1,0)")
    text = F.try_add(F.try_add(high, middle), low).cast("string")
    if scale:
        text = F.lpad(text, F.greatest(F.length(text), F.lit(scale + 1)), F.lit("0"))
        whole = F.length(text) - scale
        text = F.concat(F.substring(text, F.lit(1), whole), F.lit("."), F.substring(text, whole + 1, F.lit(scale)))
    signed = F.concat(F.when(negative, "-").otherwise(""), text)
    return F.when(F.length(raw).between(2, 32), signed.try_cast(f"decimal({precision},{scale})"))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add a literal column for each name that is absent. An explicit NULL stays NULL."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df
