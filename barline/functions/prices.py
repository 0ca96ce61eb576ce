"""Price rounding, ranges and moneyness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_price(price: Column) -> Column:
    """Two places from 1 upwards, four below it."""
    return F.when(price >= 1, F.round(price, 2)).otherwise(F.round(price, 4))


def moneyness(strike: Column, kind: Column, close: Column) -> Column:
    """Where the strike lies against the close; a missing close counts as out."""
    inside = ((kind == "call") & (strike < close)) | ((kind == "put") & (strike > close))
    return (
        F.when(strike == close, "at-the-money")
        .when(inside, "in-the-money")
        .otherwise("out-of-the-money")
    )
