"""Age and age-band expressions; ``as_of`` replaces the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed band boundaries (upper bound exclusive, label), then the catch-all.
BANDS_A = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
BAND_A_REST = "55+"
BANDS_B = [(26, "18-25"), (36, "26-35"), (51, "36-50")]
BAND_B_REST = "50+"
DAYS_PER_YEAR = 365.25


def _date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def exact_age(birth_date: Column, as_of) -> Column:
    """floor(days between birth and as_of / 365.25) as INT; NULL stays NULL."""
    days = F.datediff(_date(as_of), birth_date.cast("date"))
    return F.floor(days / F.lit(DAYS_PER_YEAR)).cast("int")


def calendar_age(birth_date: Column, as_of) -> Column:
    """year(as_of) - year(birth_date)."""
    return F.year(_date(as_of)) - F.year(birth_date)


def _band(age: Column, bands, rest: str) -> Column:
    expr = None
    for upper, label in bands:
        expr = F.when(age < upper, label) if expr is None else expr.when(age < upper, label)
    # NULL age fails every comparison and lands in the catch-all band.
    return expr.otherwise(rest)


def age_band_a(age: Column) -> Column:
    """Five bands; under-18s join 18-24, unknown age joins 55+."""
    return _band(age, BANDS_A, BAND_A_REST)


def age_band_b(age: Column) -> Column:
    """Four bands over calendar-year age (user demographics job)."""
    return _band(age, BANDS_B, BAND_B_REST)
