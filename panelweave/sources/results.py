"""Readers of stored result matrices.

File sets differ from file to file in their columns and column order, so lines
are bound to the header of their own file by name, in one scan per kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.session import cut

# Folder and file-name part of each kind of stored matrix.
KINDS = {
    "predictions": ("predictions", "predictions"),
    "lower": ("prediction intervals/lower", "lower"),
    "upper": ("prediction intervals/upper", "upper"),
    "importance": ("feature importances", "feature_importance"),
}
# Columns of a stored matrix that are not indicators.
ID_COLUMNS = ("", "Country Code", "year", "Unnamed: 0", "Unnamed: 1")
# Records of a task, whose numbers Spark's row ids count below their task's.
IN_FILE = 1 << 33
# Stored matrices are CSV files; the sink's lines are CSV in text files.
FILES = "*.{csv,txt}"


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def result_keys(path: Column) -> tuple[Column, Column]:
    """(dataset, period) of a result file.

    Either ``<dataset>_<kind>_<period>.csv`` or ``dataset=<d>/period=<p>/part-*.csv``.
    """
    plain = _decoded(path)
    foldered = F.regexp_extract(plain, r"dataset=([^/]+)/period=(\d+)/", 1)
    kinds = "|".join(stem for _, stem in KINDS.values())
    named = rf"/([^/]+?)_(?:{kinds})_(\d+)\.csv"
    dataset = F.when(foldered != "", _decoded(foldered)).otherwise(F.regexp_extract(plain, named, 1))
    period = F.when(foldered != "", F.regexp_extract(plain, r"/period=(\d+)/", 1)).otherwise(
        F.regexp_extract(plain, named, 2)
    )
    return dataset, period.cast("int")


def _width(lines: DataFrame) -> int:
    """Columns of the widest header at least: one more than the commas of a file's first line.

    Only where that line ends inside quotes, so that the header goes on, are the commas of all
    lines of the file's first block added up. No other block is read.
    """
    commas = F.length("value") - F.length(F.replace("value", F.lit(",")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    numbered = lines.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), commas.alias("commas"), (quotes % 2).alias("open"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = F.min_by(F.struct("commas", "open"), "row").alias("first")
    per_file = numbered.groupBy("file").agg(first, F.sum("commas").alias("all"))
    most = F.max(F.when(F.col("first.open") == 1, F.col("all")).otherwise(F.col("first.commas")))
    return 1 + int(per_file.agg(most).first()[0] or 0)


def _records(spark: SparkSession, folder: str, marker: str) -> DataFrame:
    """(dataset, period, line, names, cells) of every CSV record below ``folder``.

    ``line`` is a number in the order of files and lines: the place of the file, then the record's in it.
    Files with quoted line ends are not cut, so one task numbers all of a file.
    """
    dataset, period = result_keys(F.col("file"))
    files = {"recursiveFileLookup": True, "pathGlobFilter": FILES}
    width = _width(spark.read.options(**files).text(folder))
    names = [f"c{k}" for k in range(width)]
    lines = (
        spark.read.options(**files, multiLine=True, escape='"')
        .schema(", ".join(f"{n} string" for n in names))
        .csv(folder)
        .select(
            F.col("_metadata.file_path").alias("file"),
            (F.monotonically_increasing_id() % IN_FILE).alias("row"),
            F.array(*(F.coalesce(F.trim(n), F.lit("")) for n in names)).alias("cells"),
        )
    )
    is_header = F.array_contains("cells", marker)
    headers = lines.where(is_header).groupBy("file").agg(F.first("cells").alias("names"))
    place = (F.row_number().over(Window.orderBy("file")) * IN_FILE).alias("place")
    headers = cut(headers, "headers")  # a row for each file
    return (
        lines.where(~is_header)
        .join(headers.join(headers.select("file", place), "file"), "file")
        .withColumn("line", F.col("place") + F.col("row"))
        .select(dataset.alias("dataset"), period.alias("period"), "line", "names", "cells")
    )


def _field(name: str) -> Column:
    return F.try_element_at("cells", F.array_position("names", name).cast("int"))


def scan_matrix(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """``(dataset, period, line, entity, indicator, value)`` of one kind of matrix."""
    folder, _ = KINDS[kind]
    cell = F.explode(F.arrays_zip("names", "cells")).alias("cell")
    value = F.expr("try_cast(cell.cells as double)")
    return (
        _records(spark, f"{root}/{folder}", "Country Code")
        .select("dataset", "period", "line", _field("Country Code").alias("entity"), cell)
        .where(~F.col("cell.names").isin(*ID_COLUMNS))
        .select(
            "dataset", "period", "line", "entity", F.col("cell.names").alias("indicator"),
            F.when(~F.isnan(value), value).alias("value"),
        )
    )


def scan_importance(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset, period, line, target, feature, value)``; columns are bound by name."""
    folder, _ = KINDS["importance"]
    return _records(spark, f"{root}/{folder}", "predicted indicator").select(
        "dataset",
        "period",
        "line",
        _field("predicted indicator").alias("target"),
        _field("feature indicator").alias("feature"),
        _field("feature importance").cast("double").alias("value"),
    )


def scan_result_dir(spark: SparkSession, root: str) -> DataFrame:
    """The (dataset, period) pairs that have a stored prediction matrix."""
    dataset, period = result_keys(F.col("file"))
    folder, _ = KINDS["predictions"]
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", FILES)
        .format("binaryFile")
        .load(f"{root}/{folder}")
        .select(F.col("path").alias("file"))
        .select(dataset.alias("dataset"), period.alias("period"))
        .distinct()
    )


def scan_results(spark: SparkSession, root: str) -> DataFrame:
    """Predictions with their bounds; a file without siblings keeps null bounds.

    Of cells stored more than once the first in the order of files and lines counts.
    """
    keys = ["dataset", "period", "entity", "indicator"]

    def first(cells: DataFrame, name: str) -> DataFrame:
        """A number by a number, which is summed up in hash maps and not sorted as structs are."""
        return cells.groupBy(*keys).agg(F.min_by("value", "line").alias(name))

    out = first(scan_matrix(spark, root, "predictions"), "value")
    for kind in ("lower", "upper"):
        out = out.join(first(scan_matrix(spark, root, kind).where("value is not null"), kind), keys, "left")
    return out
