"""Exact arithmetic on money.

Row-level money is ``decimal(18,4)``; sums stay decimal, so they do not depend on the order in which tasks finish.
Ratios are taken on decimals wide enough for grand totals and with at least 13 digits after the point, then rounded
half up once.  Averages are one double division of an exact sum by an exact count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)
PROFIT = DecimalType(24, 5)

# Fixed value: share of the list price taken as cost.
COST_SHARE = Decimal("0.7")


def money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    """``price * quantity - discount``; the discount is an amount, not a rate."""
    return (money(price) * quantity - money(discount)).cast(MONEY)


def line_profit(total: Column, price: Column, quantity: Column) -> Column:
    return (total - quantity * money(price) * F.lit(COST_SHARE)).cast(PROFIT)


def exact_avg(column: Column | str) -> Column:
    """Average over the non-null values as an aggregate; null for an empty group."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def per_unit(total: Column, units: Column) -> Column:
    """Total per unit with two digits, null when there are no units."""
    return F.round(F.try_divide(total.cast(DecimalType(24, 4)), units.cast(DecimalType(12, 0))), 2)


def percent(part: Column, whole: Column) -> Column:
    """Part of a whole in percent with two digits, null when the whole is zero."""
    return F.round(F.try_divide((part * 100).cast(DecimalType(26, 5)), whole.cast(DecimalType(22, 4))), 2)
