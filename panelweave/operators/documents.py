"""Nested result documents: one per (dataset, indicator)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEVEL = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
# The parts of a stored document, in the order the files hold them.
PARTS = ("data", "upperIntervals", "lowerIntervals", "categoryImportances", "featureImportances")
DOCUMENT = T.StructType([T.StructField(p, _LEVEL) for p in PARTS])


def entity_map(value: str) -> Column:
    """entity -> value of the non-null cells, in key order."""
    entry = F.struct(F.col("key").cast("string").alias("key"), F.col(value).alias("value"))
    return F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), entry))))


def entity_maps(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Three maps per key; each omits its own nulls."""
    return cells.withColumnRenamed("entity", "key").groupBy(*keys).agg(
        entity_map("value").alias("data"),
        entity_map("upper").alias("upperIntervals"),
        entity_map("lower").alias("lowerIntervals"),
    )


def document_cells(
    cells: DataFrame, importance: DataFrame, categories: DataFrame
) -> DataFrame:
    """Documents in long form: ``(dataset, indicator, part, period, key, value)``.

    Upserts work on these rows; nesting happens once, on the way out. A row with
    a null key marks a period a part has, even when it holds no entry.
    """
    keys = ["dataset", "indicator"]

    def part(frame: DataFrame, name: str, key: str, value: str) -> DataFrame:
        return frame.where(F.col(value).isNotNull()).select(
            *keys, F.lit(name).alias("part"), "period",
            F.col(key).cast("string").alias("key"), F.col(value).alias("value"),
        )

    columns = cells.select(*keys, "period").distinct()
    # An indicator without cells in a period adds no entry for that period.
    fed = [f.join(columns, [*keys, "period"], "left_semi") for f in (importance, categories)]
    markers = columns.select(
        *keys, F.explode(F.array(*[F.lit(p) for p in PARTS])).alias("part"), "period",
        F.lit(None).cast("string").alias("key"), F.lit(None).cast("double").alias("value"),
    )
    return (
        part(cells, "data", "entity", "value")
        .unionByName(part(cells, "upperIntervals", "entity", "upper"))
        .unionByName(part(cells, "lowerIntervals", "entity", "lower"))
        .unionByName(part(fed[0], "featureImportances", "feature", "value"))
        .unionByName(part(fed[1], "categoryImportances", "category", "value"))
        .unionByName(markers)
    )


def nest_documents(rows: DataFrame, keys: Sequence[str] = ("dataset", "indicator")) -> DataFrame:
    """One nested document per key from its long rows."""
    keys = list(keys)
    entry = F.when(F.col("key").isNotNull(), F.struct("key", "value"))
    entries = rows.groupBy(*keys, "part", "period").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("inner")
    )
    period = F.struct(F.col("period").cast("string").alias("key"), F.col("inner").alias("value"))
    # Maps cannot be sorted, so years are ordered through their keys.
    levels = entries.groupBy(*keys).agg(*[
        F.collect_list(F.when(F.col("part") == p, period)).alias(p) for p in PARTS
    ])
    document = F.struct(*[
        F.map_from_entries(
            F.array_sort(p, lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1))
        ).alias(p)
        for p in PARTS
    ])
    return levels.select(*keys, document.alias("document"))


def flatten_documents(documents: DataFrame, keys: Sequence[str] = ("dataset", "indicator")) -> DataFrame:
    """The long rows of nested documents."""
    keys = list(keys)
    part = F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.coalesce(F.col(f"document.{p}"), F.create_map().cast(_LEVEL)).alias("level"))
        for p in PARTS
    ]))
    return (
        documents.select(*keys, part.alias("p"))
        .select(*keys, "p.part", F.explode("p.level").alias("period", "inner"))
        .select(*keys, "part", F.col("period").cast("int").alias("period"), F.explode_outer("inner").alias("key", "value"))
    )


def upsert_rows(
    stored: DataFrame, new: DataFrame, mode: str, keys: Sequence[str] = ("dataset", "indicator")
) -> DataFrame:
    """Stored document rows after a run.

    ``update`` keeps the stored periods a document did not recompute; ``replace``
    and ``new`` rebuild the documents this run produced. Other documents stay.
    """
    if mode not in ("new", "update", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    on = [*keys, "period"] if mode == "update" else list(keys)
    produced = new.select(*on).distinct()
    return stored.join(produced, on, "left_anti").unionByName(new)
