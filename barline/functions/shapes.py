"""JSON fields that hold one value or a list of them, and nested lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters and projections must not repeat.

    Exploding an array of one is a step that neither filters nor projections
    move through, so a parse or a match is not copied into each of its uses.
    """
    return df.withColumn(name, F.explode(F.array(column)))


def objects(text: Column, fields: str) -> Column:
    """An array of structs from JSON text that is one object or a list of them.

    A top-level array schema accepts both forms. Null in, null out, so that
    ``explode`` drops documents without the field.
    """
    return F.from_json(text, f"array<struct<{fields}>>")


def scalars(text: Column) -> Column:
    """An array of strings from text that is one bare scalar or a JSON list."""
    is_list = F.startswith(F.ltrim(text), F.lit("["))
    return F.when(is_list, F.from_json(text, "array<string>")).when(
        text.isNotNull(), F.array(text)
    )


def flat(lists: Column) -> Column:
    """One list from a list of lists of strings, without nulls and empty strings."""
    solid = F.filter(lists, lambda inner: inner.isNotNull())
    return F.filter(F.flatten(solid), lambda x: x.isNotNull() & (x != ""))
