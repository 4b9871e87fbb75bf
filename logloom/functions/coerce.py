"""Text -> number coercion shared by predicates, spans and rollups.

Event fields arrive as text, so every numeric operation starts with a guarded
cast: Spark's own cast accepts ``'5d'`` or ``' 5 '``, which are not numbers
here. NaN never compares equal to or above anything, hence it becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of a number.
DECIMAL_TEXT = r"(?i)^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$"
INFINITY_TEXT = r"(?i)^[+-]?(inf|infinity)$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: Column | str) -> Column:
    """DOUBLE value of a text field, NULL when it is not a finite number or an infinity."""
    text = as_column(value).cast("string")
    number = text.try_cast("double")
    infinite = number.isin(float("inf"), float("-inf"))
    return F.when(text.rlike(DECIMAL_TEXT) & ~infinite, number).when(
        text.rlike(INFINITY_TEXT), number
    )


def to_number0(value: Column | str) -> Column:
    """As :func:`to_number`, with 0 for anything that does not coerce."""
    return F.coalesce(to_number(value), F.lit(0.0))


def to_int64(value: Column | str) -> Column:
    """BIGINT, exact for integer text (64-bit ids survive), truncating otherwise, 0 on failure."""
    text = as_column(value).cast("string")
    exact = F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
    return F.coalesce(exact, to_number(text).try_cast("bigint"), F.lit(0).cast("bigint"))
