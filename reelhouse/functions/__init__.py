"""Column expressions shared by the operators."""

from reelhouse.functions.periods import moment, month_of, quarter_of, within, year_of
from reelhouse.functions.text import full_address, same_text, size_label
from reelhouse.functions.rental import RATING_AGES, exact, expected_age, late_days

__all__ = [
    "RATING_AGES",
    "exact",
    "expected_age",
    "full_address",
    "late_days",
    "moment",
    "month_of",
    "quarter_of",
    "same_text",
    "size_label",
    "within",
    "year_of",
]
