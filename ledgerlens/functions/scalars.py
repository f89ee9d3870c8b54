"""Column functions, all built from ``pyspark.sql.functions``.

Everything here returns a ``Column`` and stays inside whole-stage codegen; no
Python runs per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------- dates

def day_of(col: Column | str) -> Column:
    """``make_date(year(d), month(d), day(d))`` -- the reference's day key."""
    c = _c(col)
    return F.make_date(F.year(c), F.month(c), F.dayofmonth(c))


def year_range(col: Column | str, year: int) -> Column:
    """``year(col) = year`` written as a range so the parquet scan can prune.

    ``year(x) = 1998`` reaches the scan only as ``IsNotNull(x)``; the range
    becomes ``GreaterThanOrEqual``/``LessThan`` pushed filters and row-group
    statistics skip whole row groups.
    """
    c = _c(col)
    lo = F.lit(_dt.date(year, 1, 1))
    hi = F.lit(_dt.date(year + 1, 1, 1))
    return (c >= lo) & (c < hi)


def week_start(col: Column | str) -> Column:
    """``DATE_TRUNC('WEEK', d)`` as a date (weeks start on Monday)."""
    return F.date_trunc("week", _c(col)).cast("date")


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "month")


def epoch_to_date(col: Column | str) -> Column:
    """Epoch seconds (double) -> timestamp -> date, in the session time zone."""
    return _c(col).cast("timestamp").cast("date")


def batch_from_date_after(col: Column | str, pivot: str) -> Column:
    """Batch number of the registration replay.

    1 for days before ``pivot``, else day of month + 1 (month is ignored, as in
    the reference; NULL date -> NULL batch).
    """
    d = _c(col)
    return F.when(d < F.lit(pivot).cast("date"), F.lit(1)).otherwise(F.dayofmonth(d) + 1)


def batch_from_date_through(col: Column | str, pivot: str) -> Column:
    """Day number of the daily replay: 1 up to and including ``pivot``, else day of month."""
    d = _c(col)
    return F.when(d <= F.lit(pivot).cast("date"), F.lit(1)).otherwise(F.dayofmonth(d))


# --------------------------------------------------------------------- numbers

def round_money(col: Column | str) -> Column:
    """``ROUND(x, 2)`` (HALF_UP on decimals) returned as double."""
    return F.round(_c(col), 2).cast("double")


def to_cents(col: Column | str) -> Column:
    """Money as exact integer cents (``bigint``) for values with at most two decimals.

    Sums of cents are plain long additions -- several times faster than
    ``decimal`` sums, whose 28-digit buffers are BigDecimal-backed -- and
    exact up to 9.2e16 per group; beyond that ANSI mode raises, it never wraps.
    """
    return F.rint(_c(col).cast("double") * 100).cast("bigint")


def cents_to_money(col: Column | str) -> Column:
    """Integer cents back to an exact ``decimal(38,2)``."""
    return (_c(col).cast("decimal(38,0)") / 100).cast("decimal(38,2)")


def cents_to_double(col: Column | str) -> Column:
    """Integer cents as the double closest to the exact amount (output form)."""
    return cents_to_money(col).cast("double")


def money_avg2(col: Column | str) -> Column:
    """Aggregate: average of a money column, summed exactly in cents, rounded to 2."""
    c = _c(col)
    return ratio2(cents_to_money(F.sum(to_cents(c))), F.count(c))


def _round6_then2(x: Column) -> Column:
    # Fix the quotient to 6 places first, then round half-up to 2, so that a
    # value like 1.005 is not decided by its binary representation.
    return F.round(x.cast("decimal(38,6)"), 2).cast("double")


def ratio2(num: Column | str, den: Column | str) -> Column:
    """``ROUND(num / den, 2)``; NULL when ``den`` is 0 or NULL (never raises)."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return _round6_then2(q)


def avg2(col: Column | str) -> Column:
    """Aggregate: average rounded to 2 places (same rounding as :func:`ratio2`)."""
    c = _c(col)
    return _round6_then2(F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double")))


def threshold_flag(col: Column | str, threshold, op: str = "<") -> Column:
    """Highlight rule of a widget cell: ``value <op> threshold`` (NULL stays NULL)."""
    c = _c(col)
    ops = {"<": c < threshold, "<=": c <= threshold, ">": c > threshold,
           ">=": c >= threshold, "=": c == threshold, "!=": c != threshold}
    return ops[op]


# --------------------------------------------------------------------- text

def concat_strict(*parts) -> Column:
    """SQL ``CONCAT``: NULL as soon as one part is NULL."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def email_to_name(col: Column | str) -> Column:
    """Local part of an e-mail, lower-cased, non ``[a-z0-9_]`` replaced by ``_``."""
    local = F.substring_index(_c(col), "@", 1)
    return F.regexp_replace(F.lower(local), "[^a-z0-9_]", "_")


def slug(col: Column | str) -> Column:
    """Runs of non-alphanumerics collapse to one ``-``."""
    return F.regexp_replace(_c(col), "[^a-zA-Z0-9]+", "-")


def path_name(col: Column | str) -> Column:
    """Last ``/`` segment of a path (empty after a trailing slash)."""
    return F.element_at(F.split(_c(col), "/"), -1)


# --------------------------------------------------------------------- display formats

# Currency symbols for the codes the formats use.
CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£"}


def format_plain(col: Column | str, places: int = 2) -> Column:
    """Plain number, exact ``places`` decimals, no group separator."""
    return F.round(_c(col).cast("decimal(38,10)"), places).cast(f"decimal(38,{places})").cast("string")


def format_currency(col: Column | str, code: str = "USD", places: int = 2) -> Column:
    """Currency with group separators, e.g. ``$1,234.50`` / ``-$3.00``."""
    c = _c(col)
    sym = CURRENCY_SYMBOLS.get(code, code + " ")
    body = F.format_number(F.abs(c).cast("decimal(38,10)"), places)
    return F.when(c.isNull(), None).when(c < 0, F.concat(F.lit("-" + sym), body)) \
        .otherwise(F.concat(F.lit(sym), body))


def format_compact(col: Column | str, max_places: int = 2) -> Column:
    """Compact number (``1.5K``, ``2.25M``, ``3B``) with at most ``max_places`` decimals."""
    c = _c(col).cast("double")
    a = F.abs(c)

    def fmt(x: Column, suffix: str) -> Column:
        s = F.round(x.cast("decimal(38,10)"), max_places).cast(f"decimal(38,{max_places})").cast("string")
        s = F.regexp_replace(s, "\\.?0+$", "") if max_places > 0 else s
        return F.concat(s, F.lit(suffix))

    return (F.when(c.isNull(), None)
            .when(a >= 1e9, fmt(c / 1e9, "B"))
            .when(a >= 1e6, fmt(c / 1e6, "M"))
            .when(a >= 1e3, fmt(c / 1e3, "K"))
            .otherwise(fmt(c, "")))
