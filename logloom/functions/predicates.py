"""Event predicates as boolean Columns with two-valued logic.

Every leaf is FALSE (never NULL) on an absent or null field, for negative
operators too; ``~leaf`` on an absent field is therefore TRUE. Combine leaves
with ``&``, ``|`` and ``~``.

Fields are looked up in the ``attrs`` map (names are case-sensitive and may
hold ``.``, ``$`` or ``@``); the ``@`` names of :data:`CORE_FIELDS` read the
typed columns. Predicates on core columns reach the file scan, those on map
entries do not, so promote the fields you filter on most to columns.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.coerce import to_number
from logloom.functions.regex import java_regex

# Built-in event keys and the columns that hold them.
CORE_FIELDS = {
    "@time": "event_time",
    "@sequence": "sequence",
    "@raw": "raw",
    "@status": "status",
    "@origin": "origin",
}

Field = str | Column


def field(name: Field) -> Column:
    """Text value of a field: a core column, or the entry of ``attrs`` called ``name``."""
    if isinstance(name, Column):
        return name.cast("string")
    if name in CORE_FIELDS:
        return F.col(CORE_FIELDS[name]).cast("string")
    return F.col("attrs")[name]


def _present(name: Field, test: Column) -> Column:
    """``test``, and FALSE when the field is absent and ``test`` therefore NULL.

    For a column in the form that file scans understand; a map entry, which they
    never see, is looked up only once.
    """
    if isinstance(name, str) and name not in CORE_FIELDS:
        return F.coalesce(test, F.lit(False))
    column = name if isinstance(name, Column) else F.col(CORE_FIELDS[name])
    return column.isNotNull() & test


def _is_sequence(name: Field) -> bool:
    """The one core field that is a number already: it is compared without parsing."""
    return isinstance(name, str) and name == "@sequence"


def _literal(value) -> Column:
    return F.lit(int(value) if float(value).is_integer() and abs(value) < 2**63 else float(value))


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _equals(name: Field, value) -> Column:
    """Equality, NULL or FALSE when the field is absent."""
    if isinstance(value, bool):
        return field(name) == ("true" if value else "false")
    if _is_number(value):
        if math.isnan(value):
            return F.lit(False)
        if _is_sequence(name):
            return F.col("sequence") == _literal(value)
        return F.coalesce(to_number(field(name)) == F.lit(float(value)), F.lit(False))
    return field(name) == F.lit(value)


def eq(name: Field, value) -> Column:
    """Numeric equality for a number, exact text equality for a string or bool."""
    return _present(name, _equals(name, value))


def ne(name: Field, value) -> Column:
    different = ~_equals(name, value)
    if _is_number(value):  # numeric equality is FALSE, not NULL, on an absent field
        different = field(name).isNotNull() & different
    return _present(name, different)


def _ordered(name: Field, value, compare) -> Column:
    if not _is_number(value) or math.isnan(value):
        return F.lit(False)
    if _is_sequence(name):
        return _present(name, compare(F.col("sequence"), _literal(value)))
    return F.coalesce(compare(to_number(field(name)), F.lit(float(value))), F.lit(False))


def gt(name: Field, value) -> Column:
    """Numeric ``>``; FALSE unless both sides are numbers (text has no order)."""
    return _ordered(name, value, lambda a, b: a > b)


def ge(name: Field, value) -> Column:
    return _ordered(name, value, lambda a, b: a >= b)


def lt(name: Field, value) -> Column:
    return _ordered(name, value, lambda a, b: a < b)


def le(name: Field, value) -> Column:
    return _ordered(name, value, lambda a, b: a <= b)


def match(name: Field, pattern: str) -> Column:
    """Unanchored regex search on the text of the field."""
    return _present(name, field(name).rlike(java_regex(pattern)))


def nmatch(name: Field, pattern: str) -> Column:
    """Field present and not matching."""
    return _present(name, ~field(name).rlike(java_regex(pattern)))


def exists(name: Field) -> Column:
    """Field present with a non-empty value."""
    return _present(name, field(name) != "")


_OPERATORS = {
    "=": eq,
    "!=": ne,
    ">": gt,
    ">=": ge,
    "<": lt,
    "<=": le,
    "~": match,
    "!~": nmatch,
}


def typed_value(op: str, value):
    """Type a clause value by its shape: regex operators take text, number-shaped text is a number."""
    if op in ("~", "!~") or not isinstance(value, str):
        return value
    if value.strip() != value or "_" in value:
        return value
    try:
        return float(value) if value.isascii() else value
    except ValueError:
        return value


def clauses(items: list[tuple[str, str, object]]) -> Column:
    """AND of ``(field, operator, value)`` clauses, in order; no clause keeps every row."""
    leaves = []
    for name, op, value in items:
        if op not in _OPERATORS:
            raise ValueError(f"unknown operator {op!r}, expected one of {sorted(_OPERATORS)}")
        leaves.append(_OPERATORS[op](name, typed_value(op, value)))
    return reduce(and_, leaves, F.lit(True))


def line_rules(include: list[str] = (), exclude: list[str] = (), line: Field = "@raw") -> Column:
    """Every include regex must match the line and no exclude regex may."""
    text = F.coalesce(field(line), F.lit(""))
    keep = [text.rlike(java_regex(p)) for p in include]
    drop = [~text.rlike(java_regex(p)) for p in exclude]
    return reduce(and_, keep + drop, F.lit(True))


def field_rules(
    include: list[tuple[str, str]] = (), exclude: list[tuple[str, str]] = ()
) -> Column:
    """``(field, regex)`` rules: an absent field fails an include and survives an exclude."""
    keep = [match(name, p) for name, p in include]
    drop = [~match(name, p) for name, p in exclude]
    return reduce(and_, keep + drop, F.lit(True))


def name_contains(column: Field, part: str) -> Column:
    """Case-insensitive containment on a column of field names."""
    name = F.col(column) if isinstance(column, str) else column
    return F.contains(F.lower(name), F.lit(part.lower()))
