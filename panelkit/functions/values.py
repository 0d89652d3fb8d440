"""Scalar column functions: conversion, cleaning, guarded arithmetic, number formats."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with a costly ``value`` evaluated once, however often it is referred to."""
    return F.element_at(F.transform(F.array(value), use), 1)


def to_number(c: str | Column, dtype: str = "bigint") -> Column:
    """Text to number; null where the text is not one.

    A failing cast costs far more than a passing one, so text that cannot be a number is sorted
    out first.
    """
    column = as_column(c)
    shape = r"^\s*[+-]?\d+\s*$" if dtype in ("int", "bigint") else r"\S"
    return F.when(column.rlike(shape), column.try_cast(dtype))


def number_in(df: DataFrame, c: str, dtype: str = "bigint") -> Column:
    """A column of ``df`` as number, whether it holds text or is typed already."""
    return to_number(c, dtype) if dict(df.dtypes)[c] == "string" else F.col(c).cast(dtype)


def clean_name(c: str | Column) -> Column:
    """Underscores to spaces, outer blanks removed."""
    return F.trim(F.translate(as_column(c), "_", " "))


def relabel(c: str | Column, labels: Mapping[str, str]) -> Column:
    """Replace the listed values, keep the others. The map is a literal, so no join is needed."""
    column = as_column(c)
    if not labels:
        return column
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def strip_parens(c: str | Column) -> Column:
    """Drop a parenthesised part, with the blanks before it."""
    return F.trim(F.regexp_replace(as_column(c), r"\s*\(.*\)", ""))


def guarded(condition: Column, value: Column, other) -> Column:
    """``value`` where the condition holds, ``other`` where it is false or unknown."""
    return F.when(condition, value).otherwise(other)


def scale(numerator: str | Column, denominator: str | Column | float, factor: float = 1.0) -> Column:
    """``numerator / denominator * factor`` as double; null if the denominator is 0."""
    below = F.lit(denominator) if isinstance(denominator, (int, float)) else as_column(denominator)
    quotient = F.try_divide(as_column(numerator).cast("double"), below.cast("double"))
    return quotient if factor == 1.0 else quotient * F.lit(float(factor))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def fmt_number(c: str | Column, digits: int = 2, kind: str = "fixed") -> Column:
    """Number as text: ``fixed`` digits, ``percent`` of a share, or with ``thousands`` separators."""
    value = as_column(c).cast("double")
    if kind == "fixed":
        return F.format_string(f"%.{digits}f", value)
    if kind == "percent":
        return F.format_string(f"%.{digits}f%%", value * 100)
    if kind == "thousands":
        return F.format_string(f"%,.{digits}f", value)
    raise ValueError(f"unknown number format: {kind}")
