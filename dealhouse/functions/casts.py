"""Lenient typed casts: bad text becomes NULL, never an error.

Spark's ``try_cast`` is stricter or looser than the warehouse contract in a few
places, so each cast is guarded by a pattern first:

* integers accept decimal and exponent text and round half away from zero
  ('3.7' -> 4, '-3.5' -> -4, '1e3' -> 1000);
* doubles reject Java suffixes ('1d', '1f') but accept NaN / Infinity;
* dates need a full year-month-day ('2020' and '2020-05' are NULL), '/' is
  accepted as the separator.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealhouse.functions.text import _col, clean_str

# Accepted text shapes.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
SPECIAL_DOUBLE_PATTERN = r"^\s*[+-]?(?i)(nan|inf|infinity)\s*$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"


def double_or_null(c) -> Column:
    s = _col(c)
    return F.when(s.rlike(NUMBER_PATTERN) | s.rlike(SPECIAL_DOUBLE_PATTERN), s.try_cast("double"))


def int_or_null(c) -> Column:
    s = _col(c)
    as_double = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
    return F.round(as_double).try_cast("int")


def date_or_null(c) -> Column:
    s = F.replace(clean_str(c), F.lit("/"), F.lit("-"))
    return F.when(s.rlike(DATE_PATTERN), s.try_cast("date"))
