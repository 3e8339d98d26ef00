"""Expressions about films and rentals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Film rating and the youngest age it suits.
RATING_AGES = {"G": 0, "PG": 10, "PG-13": 13, "R": 17, "NC-17": 18}


def expected_age(rating: Column) -> Column:
    """Age for a film rating, null for any other rating."""
    age = F.lit(None).cast("int")
    for name, years in RATING_AGES.items():
        age = F.when(rating == name, F.lit(years)).otherwise(age)
    return age


def late_days(rental_date: Column, return_date: Column, duration: Column, as_of: Column) -> Column:
    """Days a copy was kept past its rental duration, counted up to ``as_of``.

    An open rental, or one returned only after ``as_of``, counts as kept until then.
    """
    kept_until = F.least(F.coalesce(return_date, as_of), as_of)
    return F.greatest(F.lit(0), F.datediff(kept_until, rental_date) - duration)


def exact(amount: Decimal | float | int | str) -> Column:
    """A money amount as a decimal constant, so comparing it does not turn the column into a double."""
    return F.lit(Decimal(str(amount)))
