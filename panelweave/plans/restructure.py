"""Stored result matrices into nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelweave.operators.documents import document_cells
from panelweave.operators.merge import category_importance
from panelweave.operators.rows import first_row
from panelweave.session import cut
from panelweave.sinks.writers import write_documents
from panelweave.sources.results import scan_importance, scan_results


def restructure(
    spark: SparkSession, results: str, dim: DataFrame, documents: str, model: str, mode: str = "new"
) -> None:
    """Reads each kind of matrix once and upserts the documents of ``model``."""
    cells = cut(scan_results(spark, results), "results")
    importance = first_row(
        scan_importance(spark, results).withColumnRenamed("target", "indicator"),
        ["dataset", "indicator", "period", "feature"], ["line"],
    ).drop("line")
    importance = cut(importance, "importances")
    categories = category_importance(importance, dim, ["dataset", "indicator", "period"])
    write_documents(document_cells(cells, importance, categories), documents, model, mode)
