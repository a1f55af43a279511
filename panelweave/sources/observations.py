"""Readers of the wide observation table and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.reshape import unpivot
from panelweave.operators.rows import drop_null_keys, named_rows, used_rows
from panelweave.operators.profile import series_screen


def scan_csv(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A CSV read by header; all columns are strings, no row is read to infer types."""
    df = spark.read.option("header", True).csv(path)
    return df.select(*columns) if columns else df


def scan_wide(
    spark: SparkSession,
    path: str,
    entity: str = "Country Code",
    indicator: str = "Indicator Code",
    keep_nulls: bool = False,
) -> DataFrame:
    """(entity, indicator) rows with a column per period, as the long panel."""
    wide = scan_csv(spark, path)
    periods = [c for c in wide.columns if c not in (entity, indicator)]
    typed = drop_null_keys(wide, entity, indicator).select(
        F.col(entity).alias("entity"),
        F.col(indicator).alias("indicator"),
        *[F.col(f"`{p}`").cast("double").alias(p) for p in periods],
    )
    return unpivot(typed, ["entity", "indicator"], periods, keep_nulls)


def scan_indicators(spark: SparkSession, path: str) -> DataFrame:
    """Indicator dimension under canonical names."""
    return scan_csv(spark, path).select(
        F.col("Indicator Code").alias("indicator"),
        F.col("Indicator").alias("name"),
        F.col("Dataset").alias("dataset"),
        F.col("Category").alias("category"),
    )


def scan_datasets(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path).select(
        F.col("Dataset Code").alias("dataset"), F.col("Dataset Name").alias("name")
    )


def import_panel(
    spark: SparkSession, folder: str, percent: float = 90, series: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(panel, indicator dimension, dataset dimension) of a data folder.

    ``series`` drops the indicators whose every series misses ``percent`` of the periods.
    """
    panel = scan_wide(spark, f"{folder}/indicatorData.csv")
    if series:
        panel = series_screen(panel, percent)
    indicators = named_rows(
        used_rows(scan_indicators(spark, f"{folder}/indicatorMeta.csv"), panel, "indicator"), "name"
    )
    datasets = named_rows(
        used_rows(scan_datasets(spark, f"{folder}/datasetMeta.csv"), indicators, "dataset"), "name"
    )
    return panel, indicators, datasets
