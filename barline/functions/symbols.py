"""Option contract symbols: root, yymmdd expiry, C or P, strike in thousandths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.shapes import computed_once
from barline.schemas import PRICE

# The two symbol formats. Text after the strike is allowed.
MARKET_SYMBOL = r"^(?:O:)?([A-Z.]+\d{6}[CP]\d{8})"
BROKER_SYMBOL = r"^([A-Z]+\d{6}[CP]\d{8})"
TAIL = 15  # characters after the root


def with_contract(df: DataFrame, symbol: str, pattern: str = MARKET_SYMBOL) -> DataFrame:
    """Add the contract columns packed in a symbol; all null where it has no match.

    The tail has a fixed width, so one match finds every part.
    """
    found = F.regexp_extract(symbol, pattern, 1)
    # regexp_extract gives '' rather than null where nothing matches.
    df = computed_once(df, "_contract", F.when(found != "", found))
    packed = F.col("_contract")
    strike = F.substring(packed, -8, 8).cast("decimal(8,0)") / F.lit(1000)
    return df.withColumns(
        {
            "underlying_ticker": F.substring(packed, F.lit(1), F.length(packed) - TAIL),
            "expiration_date": expiry(F.substring(packed, -TAIL, 6)),
            "option_type": F.when(F.substring(packed, -9, 1) == "C", "call").when(packed.isNotNull(), "put"),
            "strike_price": strike.cast(PRICE),
        }
    ).drop("_contract")


def expiry(yymmdd: Column) -> Column:
    """A date from six digits, null for an impossible one such as month 99.

    Two-digit years follow the POSIX rule: 69 to 99 are 19yy, the rest 20yy.
    """
    century = F.when(F.substring(yymmdd, 1, 2) >= "69", "19").otherwise("20")
    return F.try_to_date(F.concat(century, yymmdd), "yyyyMMdd")
