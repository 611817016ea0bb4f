"""Scalar Column builders.

Everything here returns a ``pyspark.sql.Column`` made of built-in functions, so
it stays inside whole-stage codegen. Money is DECIMAL inside a query and DOUBLE
only at the output edge (``money_out``); ratios are computed on exact decimals
and rounded HALF_UP before the DOUBLE cast, so results do not depend on binary
floating-point noise.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


# -- P4 / N1: order value ------------------------------------------------------
def order_value(quantity="quantity", unit_cost="unit_cost") -> Column:
    """Line value = quantity x unit price (exact decimal)."""
    return c(quantity).cast("decimal(10,0)") * c(unit_cost).cast(MONEY)


def money_out(col, digits: int = 2) -> Column:
    """Round an exact decimal amount and hand it out as DOUBLE (P7, money 2 dp)."""
    return F.round(c(col), digits).cast("double")


# -- P5/P6/B10: guarded ratio ------------------------------------------------
def ratio(num, den, scale: int = 1, digits: int | None = None) -> Column:
    """``scale * num / den`` with a zero/NULL guard, rounded HALF_UP on decimals.

    ``num``/``den`` are counts or integer sums, ``scale`` an integer (1 for a
    fraction, 100 for a percent). NULL when ``den`` is 0 or NULL (T10: always the
    guarded form).
    """
    n = c(num).cast("decimal(20,0)") * F.lit(int(scale)).cast("decimal(4,0)")
    q = F.try_divide(n.cast("decimal(20,0)"), c(den).cast("decimal(20,0)"))
    if digits is not None:
        q = F.round(q, digits)
    return q.cast("double")


def ratio_dec(num, den, digits: int) -> Column:
    """``num / den`` for exact decimals (money), NULL-guarded, HALF_UP at ``digits``."""
    q = F.try_divide(c(num).cast("decimal(38,18)"), c(den).cast("decimal(38,2)"))
    return F.round(q, digits).cast("double")


def avg_exact(total, count, digits: int) -> Column:
    """Average from an exact (integer or decimal) total and a count, rounded HALF_UP."""
    # decimal(38,18) / decimal(38,0) keeps 18 fraction digits, so the HALF_UP
    # rounding below is the only rounding that can change a digit we output.
    q = F.try_divide(c(total).cast("decimal(38,18)"), c(count).cast("decimal(38,0)"))
    return F.round(q, digits).cast("double")


# -- P9 / M7 / M8 / M9: day differences -------------------------------------
def variance_days(actual="actual_delivery_date", expected="expected_delivery_date") -> Column:
    """Signed delivery variance in days; negative = early."""
    return F.datediff(c(actual), c(expected))


def days_late(actual="actual_delivery_date", expected="expected_delivery_date") -> Column:
    """Days late for late receipts, NULL otherwise (M8)."""
    d = variance_days(actual, expected)
    return F.when(d > 0, d)


def lead_days(actual="actual_delivery_date", ordered="order_date") -> Column:
    """Actual lead time in calendar days (M9)."""
    return F.datediff(c(actual), c(ordered))


def on_time(actual="actual_delivery_date", expected="expected_delivery_date") -> Column:
    """True when received on or before the expected date; NULL when not received."""
    return c(actual) <= c(expected)


# -- P10 / P11: time buckets -------------------------------------------------
def time_bucket(col, unit: str = "month") -> Column:
    """Truncate a date to ``unit`` (year, quarter, month, week, day) as TIMESTAMP."""
    return F.date_trunc(unit, c(col))


def month_start(col) -> Column:
    """First day of the month as DATE (the reference's DATE_TRUNC('month', d),
    kept as a DATE so the value does not depend on the session time zone)."""
    return F.trunc(c(col), "month")


# -- P19: calendar-month range (sargable) ------------------------------------
def in_month(col, month: str | _dt.date) -> Column:
    """``col`` falls in the calendar month starting at ``month`` (YYYY-MM or date).

    Written as a half-open range on the raw column so parquet can push it down.
    """
    start = _dt.date.fromisoformat(month + "-01") if isinstance(month, str) and len(month) == 7 \
        else (_dt.date.fromisoformat(month) if isinstance(month, str) else month)
    return (c(col) >= F.lit(start)) & (c(col) < F.add_months(F.lit(start), 1))


def in_months(col, first: str, last: str) -> Column:
    """``col`` falls in months ``first``..``last`` inclusive (YYYY-MM)."""
    lo = _dt.date.fromisoformat(first + "-01")
    hi = _dt.date.fromisoformat(last + "-01")
    return (c(col) >= F.lit(lo)) & (c(col) < F.add_months(F.lit(hi), 1))


# -- P18: multi-select membership --------------------------------------------
def member_of(col, values) -> Column:
    """``isin`` with the dashboard rule that an empty selection means no filter."""
    values = list(values or [])
    return F.lit(True) if not values else c(col).isin(values)


# -- P20: presentation ---------------------------------------------------------
def fmt_money(col, digits: int = 2, prefix: str = "$") -> Column:
    return F.concat(F.lit(prefix), F.format_number(c(col).cast("double"), digits))


def fmt_percent(col, digits: int = 1, fraction: bool = False) -> Column:
    v = c(col).cast("double") * (100.0 if fraction else 1.0)
    return F.concat(F.format_number(v, digits), F.lit("%"))


def fmt_count(col) -> Column:
    return F.format_number(c(col).cast("double"), 0)
