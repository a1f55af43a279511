"""Writers of raw results, matrices, documents and model metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.functions import safe_name
from panelweave.operators.documents import flatten_documents, nest_documents, upsert_rows
from panelweave.operators.ranking import split_hot
from panelweave.session import cut
from panelweave.sources.documents import MODEL_ATTRIBUTES, scan_documents, scan_model_metadata
from panelweave.sources.results import KINDS


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything to read at ``path``."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    return True


def write_raw(results: DataFrame, path: str, append: bool = True) -> None:
    """Raw predictions, importances or scores, one folder per (model, period).

    Appending adds rows; otherwise only the (model, period) folders of this run
    are rewritten, so a rerun after a failure leaves no duplicates.
    """
    writer = results.write.partitionBy("model", "period")
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _quoted(cell: Column) -> Column:
    needs = cell.rlike('[",\\r\\n]')
    return F.when(needs, F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)


def write_matrices(
    filled: DataFrame, importance: DataFrame, root: str, rows_per_file: int = 1_000_000
) -> None:
    """Entity x indicator matrices of values and bounds, and importance lists.

    ``filled(dataset, period, entity, indicator, value, lower, upper)``. Every
    (dataset, period) has its own columns, so lines of CSV are built as text and
    all matrices of a kind are written by one job, as part files in
    ``<kind>/dataset=<d>/period=<p>/``. A matrix of many entities is split over
    files, each with the header first; so is a long importance list.
    """
    key = ["dataset", "period"]
    filled = cut(filled, "matrices")
    headers = filled.groupBy(*key).agg(F.sort_array(F.collect_set("indicator")).alias("names"))
    records = filled.groupBy(*key, "entity").agg(
        F.map_from_entries(
            F.collect_list(F.struct("indicator", F.struct("value", "lower", "upper")))
        ).alias("cells")
    )
    records = cut(split_hot(records, key, ["entity"], rows_per_file).join(headers, key), "records")
    slices = records.select(*key, "salt", "names").dropDuplicates([*key, "salt"])

    def line(first: Column, second: Column, cells: Column) -> Column:
        return F.concat_ws(",", _quoted(first), second, F.array_join(cells, ","))

    head = line(F.lit("Country Code"), F.lit("year"), F.transform("names", _quoted))
    for kind, field in (("predictions", "value"), ("lower", "lower"), ("upper", "upper")):
        body = line(
            F.col("entity").cast("string"),
            F.col("period").cast("string"),
            F.transform("names", lambda n: F.coalesce(
                F.try_element_at("cells", n)[field].cast("string"), F.lit("")  # noqa: B023
            )),
        )
        lines = slices.select(*key, "salt", F.lit(0).alias("is_row"), head.alias("line")).unionByName(
            records.select(*key, "salt", F.lit(1).alias("is_row"), body.alias("line"))
        )
        (
            lines.repartition(*key, "salt")
            .sortWithinPartitions(*key, "salt", "is_row")
            .select(*key, "line")
            .write.mode("overwrite").partitionBy(*key)
            .text(f"{root}/{KINDS[kind][0]}")
        )
    listed = split_hot(importance, key, ["target", "feature"], rows_per_file)
    (
        listed.repartition(*key, "salt")
        .select(
            *key,
            F.col("target").alias("predicted indicator"),
            F.col("feature").alias("feature indicator"),
            F.col("value").alias("feature importance"),
        )
        .write.mode("overwrite").partitionBy(*key).option("header", True).option("escape", '"')
        .csv(f"{root}/{KINDS['importance'][0]}")
    )


def write_documents(rows: DataFrame, root: str, model: str, mode: str = "new") -> None:
    """Upserts the long document rows of a run into the stored documents.

    Only the datasets this run produced are rewritten.
    """
    spark = rows.sparkSession
    rows = cut(rows, "document-rows")
    if exists(spark, root):
        touched = rows.select("dataset").distinct()
        stored = scan_documents(spark, root).where(F.col("model") == model)
        stored = flatten_documents(stored.join(touched, "dataset", "left_semi"))
        rows = upsert_rows(stored, rows.select(*stored.columns), mode)
    documents = nest_documents(rows).select(
        "indicator",
        safe_name("indicator").alias("name"),
        "document",
        F.lit(model).alias("model"),
        "dataset",
    )
    (
        cut(documents, "documents")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("model", "dataset").json(root)
    )


def write_model_metadata(spark: SparkSession, path: str, model: str, attributes: dict[str, str]) -> DataFrame:
    """Sets the attributes of one model and keeps the others; one JSON map."""
    row = spark.createDataFrame(
        [(model, *[attributes.get(a) for a in MODEL_ATTRIBUTES])],
        ", ".join(["model string", *[f"`{a}` string" for a in MODEL_ATTRIBUTES]]),
    )
    models = row
    if exists(spark, path):
        stored = cut(scan_model_metadata(spark, path), "models")
        models = stored.where(F.col("model") != model).unionByName(row)
    entry = F.struct("model", F.struct(*[F.col(f"`{a}`") for a in MODEL_ATTRIBUTES]).alias("a"))
    table = models.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    table.coalesce(1).write.mode("overwrite").text(path)
    return models
