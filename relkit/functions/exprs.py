"""Column expressions shared by the queries.  All are built-in Spark
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def net_price(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return F.col(price) * (F.lit(1) - F.col(discount))


def charge(price: str = "l_extendedprice", discount: str = "l_discount",
           tax: str = "l_tax") -> Column:
    return net_price(price, discount) * (F.lit(1) + F.col(tax))


def month_start(col: str | Column) -> Column:
    """First instant of the month.  ``date_trunc`` returns a zoned
    timestamp; cast back so a ``timestamp_ntz`` input stays zone-free."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("month", c).cast("timestamp_ntz")


def year_of(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c)


def money(c: Column, digits: int = 2) -> Column:
    """Round a floating-point total.  Sums of doubles depend on the order
    of addition in their last digits; reports show them rounded."""
    return F.round(c, digits)
