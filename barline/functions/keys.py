"""Surrogate keys, paths and dotted names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bar_id(key: Column, trade_date: Column) -> Column:
    """``key_yyyy-MM-dd``; null if either part is, as SQL's ``||`` would give."""
    return F.concat(key, F.lit("_"), F.date_format(trade_date, "yyyy-MM-dd"))


def file_key(path: Column) -> Column:
    """The text before the first underscore of the last segment of a file's URI."""
    return F.split_part(F.element_at(F.split(decoded(path), "/"), -1), F.lit("_"), F.lit(1))


def decoded(uri: Column) -> Column:
    """A URI's text without percent-encoding; text that is none stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)


def last_segment(dotted: Column) -> Column:
    return F.element_at(F.split(dotted, r"\."), -1)


def moved(path: Column, source: str, target: str) -> Column:
    """``path`` with the first ``source`` replaced by ``target``."""
    at = F.instr(path, source)
    return F.when(
        at > 0,
        F.concat(
            F.substring(path, F.lit(1), at - 1),
            F.lit(target),
            F.substring(path, at + len(source), F.length(path)),
        ),
    ).otherwise(path)
