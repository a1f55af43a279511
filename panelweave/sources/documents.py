"""Readers of nested documents and of the model metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.operators.documents import DOCUMENT

# The six attributes a model is described by.
MODEL_ATTRIBUTES = (
    "Modelling Approach",
    "Model Name",
    "Parameters",
    "Model Description",
    "Model Advantage",
    "Model Drawback",
)
_STORED = T.StructType([
    T.StructField("indicator", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("document", DOCUMENT),
    T.StructField("model", T.StringType()),
    T.StructField("dataset", T.StringType()),
])


def scan_documents(spark: SparkSession, root: str) -> DataFrame:
    """``(indicator, name, document, model, dataset)`` as the document sink writes them."""
    return spark.read.schema(_STORED).json(root)


def scan_document_files(spark: SparkSession, root: str) -> DataFrame:
    """Documents stored as ``<model>/<dataset>/<indicator>.json``, one object per file."""
    parts = F.split(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "/")
    docs = (
        spark.read.schema(DOCUMENT)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(root)
    )
    return docs.select(
        F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("indicator"),
        F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("name"),
        F.struct(*docs.columns).alias("document"),
        F.element_at(parts, -3).alias("model"),
        F.element_at(parts, -2).alias("dataset"),
    )


def scan_model_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(model, <attribute> ...)`` from a JSON map of models."""
    attributes = T.StructType([T.StructField(a, T.StringType()) for a in MODEL_ATTRIBUTES])
    schema = T.MapType(T.StringType(), attributes)
    return (
        spark.read.option("wholetext", True)
        .text(path)
        .select(F.explode(F.from_json("value", schema)).alias("model", "a"))
        .select("model", "a.*")
    )
