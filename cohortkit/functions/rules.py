"""Rule tables as Column expressions.

A rule table is an ordered list of ``(condition, label)``; the first condition
that is TRUE wins, a NULL condition counts as not taken (SQL ``CASE``
semantics), and a default closes the table.  Everything compiles to one
``CASE WHEN`` expression inside whole-stage codegen — no UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """Ordered ``CASE WHEN``: first TRUE condition wins, else ``default``."""
    rules = list(rules)
    if not rules:
        return F.lit(default)
    expr = None
    for cond, label in rules:
        value = label if isinstance(label, Column) else F.lit(label)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def bound_predicate(c, op: str, bound) -> Column:
    """Predicate of one band rule.

    ``op`` is one of ``lt le gt ge eq`` (one bound), ``between`` (inclusive
    both ends, SQL BETWEEN), ``range`` (``[lo, hi)``), ``open_range``
    (``(lo, hi)``).
    """
    c = _col(c)
    if op == "lt":
        return c < bound
    if op == "le":
        return c <= bound
    if op == "gt":
        return c > bound
    if op == "ge":
        return c >= bound
    if op == "eq":
        return c == bound
    lo, hi = bound
    if op == "between":
        return c.between(lo, hi)
    if op == "range":
        return (c >= lo) & (c < hi)
    if op == "open_range":
        return (c > lo) & (c < hi)
    raise ValueError(f"unknown band operator {op!r}")


def band(c, table: Sequence[tuple[str, object, str]], default: str) -> Column:
    """Band a value by an ordered table of ``(op, bound, label)`` rows."""
    return classify(((bound_predicate(c, op, b), label) for op, b, label in table), default)


def yn(cond: Column) -> Column:
    """Render a condition as 'Y'/'N'; NULL renders 'N' (SQL ``IF`` semantics)."""
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def present_flag(c) -> Column:
    """'Y' when the value is present, 'N' when NULL."""
    return yn(_col(c).isNotNull())


def is_y(c) -> Column:
    return _col(c) == F.lit("Y")


def any_flag(flags: Sequence[str]) -> Column:
    """'Y' when any of the Y/N flag columns is 'Y', else 'N'."""
    return yn(reduce(lambda a, b: a | b, (is_y(f) for f in flags)))


def first_reason(reasons: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first 'Y' flag in priority order, else ``default``."""
    return classify(((is_y(f), label) for f, label in reasons), default)


def lower_equals_flag(c, value: str) -> Column:
    """``IF(LOWER(c) = value, 'Y', 'N')`` — case-insensitive, NULL gives 'N'."""
    return yn(F.lower(_col(c)) == F.lit(value))


def least_in(cols: Sequence[str | Column], lo: int, hi: int) -> Column:
    """``LEAST(cols) BETWEEN lo AND hi``.

    Spark's ``least`` skips NULLs and is NULL only when every input is NULL,
    so a partially scored row can still be a hit.
    """
    return F.least(*[_col(c) for c in cols]).between(lo, hi)


def any_null(cols: Sequence[str | Column]) -> Column:
    return reduce(lambda a, b: a | b, (_col(c).isNull() for c in cols))


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
