"""Column expressions for keys, names and cell values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_key(left: str | Column, right: str | Column) -> Column:
    """``left-right``; null when either part is null."""
    return F.concat(left, F.lit("-"), right)


def safe_name(name: str | Column) -> Column:
    """A document name usable in a path: each ``/`` becomes a blank."""
    return F.translate(name, "/", " ")


def base_feature(name: str | Column) -> Column:
    """The indicator of a lagged feature written as ``indicator#lag``."""
    return F.regexp_extract(name, r"^(.*?)(#\d+)?$", 1)


def result_name_parts(path: str | Column) -> tuple[Column, Column]:
    """(dataset, period) from ``.../<dataset>_<kind>_<period>.csv``."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"\.csv$", "")
    return (
        F.element_at(F.split(stem, "_"), 1),
        F.element_at(F.split(stem, "_"), -1).cast("int"),
    )


def null_if_nan(value: str | Column) -> Column:
    """Cells hold real nulls, never NaN."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value), value)
