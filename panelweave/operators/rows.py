"""Filters, projections and label sets on the long panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    return df.dropna(how="any", subset=list(keys))


def named_rows(dim: DataFrame, name: str) -> DataFrame:
    """Dimension rows that carry a name."""
    return dim.where(F.col(name).isNotNull())


def used_rows(dim: DataFrame, users: DataFrame, code: str) -> DataFrame:
    """Dimension rows whose code occurs in ``users``."""
    return dim.join(users.select(code).distinct(), code, "left_semi")


def in_focus(df: DataFrame, focus: DataFrame) -> DataFrame:
    return df.join(focus, "entity", "left_semi")


def mark_focus(df: DataFrame, focus: DataFrame) -> DataFrame:
    """Adds ``in_focus``; ``focus`` must hold each entity once."""
    marks = focus.select("entity", F.lit(True).alias("in_focus"))
    return df.join(marks, "entity", "left").withColumn(
        "in_focus", F.coalesce("in_focus", F.lit(False))
    )


def cross_section(panel: DataFrame, period: int) -> DataFrame:
    return panel.where(F.col("period") == period)


def period_range(panel: DataFrame, start: int, end: int) -> DataFrame:
    """Periods of ``[start, end)``; the end is excluded."""
    return panel.where((F.col("period") >= start) & (F.col("period") < end))


def history_slice(panel: DataFrame, period: int, window: int, first: int) -> DataFrame:
    """Periods ``max(first, period - window)`` to ``period``, both included."""
    return panel.where(F.col("period").between(max(first, period - window), period))


def drop_all_null_rows(cells: DataFrame) -> DataFrame:
    """Cells of series with at least one value."""
    seen = cells.where("value is not null").select("entity", "indicator").distinct()
    return cells.join(seen, ["entity", "indicator"], "left_semi")


def drop_all_null_columns(cells: DataFrame, column: str) -> DataFrame:
    """Cells of those periods (or indicators) with at least one value."""
    seen = cells.where("value is not null").select(column).distinct()
    return cells.join(seen, column, "left_semi")


def only(df: DataFrame, labels: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is among ``labels``."""
    return df.join(labels, on if isinstance(on, str) else list(on), "left_semi")


def label_union(column: str, *frames: DataFrame) -> DataFrame:
    """Every label of ``column`` that any of the frames holds."""
    out = frames[0].select(column)
    for frame in frames[1:]:
        out = out.union(frame.select(column))
    return out.distinct()


def append(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order``.

    A ``min`` over structs combines on the map side, so a key with many copies
    sends one row per task instead of all of them.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), ranked).alias("row"))
        .select(*keys, "row.*")
    )


def lookup(
    df: DataFrame, dim: DataFrame, on: str, attribute: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``attribute`` of the first dimension row of each code, by ``order``.

    ``order`` names what tells the rows' order, such as a scan's line; without it
    ``dim`` must hold each code once.
    """
    first = dim.select(on, attribute) if order is None else first_row(
        dim.select(on, attribute, *[c for c in order if c not in (on, attribute)]), [on], order
    ).select(on, attribute)
    return df.join(first, on, "inner")


def normalise_labels(df: DataFrame, period: str = "year", names: dict[str, str] | None = None) -> DataFrame:
    """Typed period labels and canonical column names."""
    out = df.withColumn(period, F.col(period).cast("int"))
    return out.withColumnsRenamed({period: "period", **(names or {})})


def members(dim: DataFrame, group: str, label: str) -> DataFrame:
    """The sorted list of labels of each group."""
    distinct = dim.select(group, label).distinct()
    return distinct.groupBy(group).agg(F.sort_array(F.collect_list(label)).alias("members"))


def train_split(panel: DataFrame, targets: DataFrame, focus: DataFrame) -> DataFrame:
    """(period, target, entity, y, in_focus): the observed cells of ``targets(period, indicator)``."""
    train = only(panel.where("value is not null"), targets, ["period", "indicator"])
    return mark_focus(train, focus).select(
        "period", F.col("indicator").alias("target"), "entity", F.col("value").alias("y"), "in_focus"
    )


def predict_split(cells: DataFrame) -> DataFrame:
    """(period, target, entity) of the densified cells without a value."""
    return cells.where("value is null").select("period", F.col("indicator").alias("target"), "entity")


def window_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and predict rows of ``rows(period, target, window, entity, y, ...)``: every window's labelled rows, and of
    those without a label the rows whose window is the target period itself."""
    return rows.where("y is not null"), rows.where("y is null and window = period").drop("y")
