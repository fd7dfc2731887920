"""Canonical JSON of identity fields, and keys made from it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_part(c: Column, number: bool = False) -> Column:
    """One element: a bare number, a quoted string, or ``null``; '' is not null."""
    text = c.cast("string") if number else F.to_json(F.array(c.cast("string")))
    inner = text if number else F.substring(text, 2, F.length(text) - 2)
    return F.when(c.isNull(), F.lit("null")).otherwise(inner)


def canonical_json(parts: list[tuple[Column, bool]]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *[json_part(c, n) for c, n in parts]), F.lit("]"))


def key_of(parts: list[tuple[Column, bool]]) -> Column:
    """SHA-256 of the canonical JSON; (column, is a number) each."""
    return F.sha2(canonical_json(parts), 256)


def record_json(df, names: list[str] | None = None) -> Column:
    """A whole row as a JSON object in the order of columns, nulls included; numbers bare, all else as text."""
    numbers = {"int", "bigint", "smallint", "tinyint", "double", "float"}
    kinds = dict(df.dtypes)
    parts = [F.concat(F.lit(f'"{n}": '), json_part(F.col(n), kinds[n] in numbers)) for n in (names or df.columns)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
