"""Money and percentage arithmetic with one result on every engine and every partitioning.

Averages and sums run over decimals, so they do not depend on the order in which tasks finish;
doubles appear only after the last aggregation or inside one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
LINE_MONEY = "decimal(18,2)"  # products of price and quantity; still a machine long inside Spark
TOTAL_MONEY = "decimal(38,2)"


def round2(x: Column) -> Column:
    """Two places, halves away from zero, on doubles.

    Spark's round() of a double goes through a BigDecimal per row (about 15 times slower here)
    and rounds the decimal text, so 1.005 would become 1.01; scaling first gives 1.0.
    """
    return F.signum(x) * F.floor(F.abs(x) * 100 + 0.5) / 100


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double, null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return round2(ratio(numerator, denominator) * 100)


def exact_avg(x: Column) -> Column:
    """Average of decimals or integers: exact sum, one division. Null over no values."""
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def total(x: Column) -> Column:
    return F.sum(x).cast(TOTAL_MONEY)
