"""Scalar functions on dates, ages and scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import MONTHS, lookup, truthy

# An ISO-8601 duration, and the days of its parts.
ISO_DURATION = r"^P(?!$)(\d+Y)?(\d+M)?(\d+W)?(\d+D)?(T(\d+H)?(\d+M)?(\d+S)?)?$"
DAYS = (("Y", 365.25), ("M", 30.44), ("W", 7.0), ("D", 1.0))


def age_days(iso: Column) -> Column:
    """Days of an ISO-8601 duration (its time part is ignored); NULL for anything else."""
    parts = [F.coalesce(F.try_to_number(truthy(F.regexp_extract(iso, rf"^P[^T]*?(\d+){u}", 1)), F.lit("9999999999")).cast("double"), F.lit(0.0)) * d for u, d in DAYS]
    return F.when(iso.rlike(ISO_DURATION), parts[0] + parts[1] + parts[2] + parts[3])


def birth_year(pub_year: Column, *ages: Column) -> Column:
    """Publication year less the first usable age, cut to a whole year; NULL without year (0 counts as none)."""
    days = F.coalesce(*[age_days(a) for a in ages])
    return F.when(F.coalesce(pub_year, F.lit(0)) != 0, (pub_year - days / 365.25).cast("int"))


def year_band(year: Column) -> Column:
    return (
        F.when(F.coalesce(year, F.lit(0)) == 0, "unknown").when(year <= 1999, "pre2000").when(year <= 2014, "2000-2014").otherwise("2015+")
    )


def publication_date(year: Column, month: Column, day: Column, medline: Column) -> Column:
    """`YYYY-MM-DD` with 01 for missing parts, month names read; a bare year where only a free date is given."""
    name = lookup(MONTHS, F.substring(F.coalesce(month, F.lit("")), 1, 3))
    m = F.coalesce(name, F.when(month.rlike(r"^\d+$"), F.lpad(month, 2, "0")), F.lit("01"))
    d = F.lpad(F.coalesce(truthy(day), F.lit("01")), 2, "0")
    return F.when(truthy(year).isNotNull(), F.concat_ws("-", year, m, d)).otherwise(truthy(F.regexp_extract(medline, r"^(\d{4})", 1)))


def half_even(c: Column) -> Column:
    """Rounding to the nearest integer, halves to the even one."""
    return F.bround(c, 0)


def hash_rank(seed: int, id_: Column) -> Column:
    """The hexadecimal SHA-1 that orders a seeded draw."""
    return F.sha1(F.concat_ws(":", F.lit(str(seed)), id_))


def shortest(c: Column) -> Column:
    """A double as the shortest text that reads back to it, in plain notation between 1e-4 and 1e16 and as `1.5e-07` beyond; whole
    numbers keep `.0`."""
    s = c.cast("string")
    plain = F.regexp_replace(F.regexp_replace(c.cast("decimal(38,22)").cast("string"), "0+$", ""), r"\.$", ".0")
    mantissa, exponent = F.regexp_replace(F.substring_index(s, "E", 1), r"\.0$", ""), F.substring_index(s, "E", -1)
    power = F.concat(F.when(F.startswith(exponent, F.lit("-")), "-").otherwise("+"), F.lpad(F.regexp_replace(exponent, "^-", ""), 2, "0"))
    return F.when(~F.contains(s, F.lit("E")), s).when((F.abs(c) >= 1e-4) & (F.abs(c) < 1e16), plain).otherwise(F.concat(mantissa, F.lit("e"), power))


def round_binary(c: Column, digits: int) -> Column:
    """`c` rounded to `digits` by its exact binary value, true ties to even (2.675 to 2 digits is 2.67, for it lies just below).

    The product with the power of ten comes as a double and its exact error (Dekker's split), which decides apparent ties.
    """
    scale = float(10**digits)
    big = c * 134217729.0
    high = big - (big - c)
    p = c * scale
    error = (high * scale - p) + (c - high) * scale
    f = F.floor(p).cast("double")
    rest = p - f
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (f % 2 != 0))))
    return (f + F.when(up, 1.0).otherwise(0.0)) / scale
