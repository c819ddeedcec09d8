"""Business formatting of numbers and dates as string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "Not available"  # fixed value
# Lower bound of the magnitude, divisor, suffix.
MAGNITUDES = [(1e9, 1e9, "B"), (1e6, 1e6, "M"), (1e3, 1e3, "K")]


def _two(x: Column) -> Column:
    return F.format_string("%.2f", F.round(x, 2))


def money(x: Column) -> Column:
    """$K/$M/$B with two decimals; the sign stands before the symbol."""
    size = F.abs(x)
    body = F.concat(F.lit("$"), _two(size))
    for bound, divisor, suffix in reversed(MAGNITUDES):
        body = F.when(size >= bound, F.concat(F.lit("$"), _two(size / divisor), F.lit(suffix))).otherwise(body)
    return F.when(x.isNull(), MISSING).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), body))


def percent(x: Column) -> Column:
    return F.when(x.isNull(), MISSING).otherwise(F.concat(_two(x), F.lit("%")))


def money_delta(x: Column) -> Column:
    return F.when(x > 0, F.concat(F.lit("+"), money(x))).otherwise(money(x))


def percent_delta(x: Column) -> Column:
    return F.when(x > 0, F.concat(F.lit("+"), percent(x))).otherwise(percent(x))


def count_text(x: Column) -> Column:
    return F.when(x.isNull(), MISSING).otherwise(F.format_number(x.cast("bigint"), 0))


def day_text(d: Column) -> Column:
    return F.when(d.isNull(), MISSING).otherwise(F.date_format(d, "dd MMM yyyy"))


def indian_rupees(x: Column) -> Column:
    """Last three digits, then groups of two: ₹12,34,567."""
    digits = F.abs(F.round(x, 0)).cast("bigint").cast("string")
    head = F.regexp_replace(F.substring(digits, F.lit(1), F.length(digits) - 3), r"(\d)(?=(\d\d)+$)", "$1,")
    tail = F.right(digits, F.lit(3))
    body = F.when(F.length(digits) > 3, F.concat(head, F.lit(","), tail)).otherwise(digits)
    return F.when(x.isNull(), MISSING).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), F.lit("₹"), body))


def cell(x: Column) -> Column:
    """Markdown table cell: pipes escaped, NULL shown as missing."""
    return F.coalesce(F.replace(x.cast("string"), F.lit("|"), F.lit("\\|")), F.lit(MISSING))
