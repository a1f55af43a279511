"""Round trips: what the sinks write, the sources read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import documents as docs
from panelweave.operators import reshape
from panelweave.plans.restructure import restructure as restructure_results
from panelweave.queries import inputs as i
from panelweave.queries.cells import given_documents, given_results
from panelweave.queries.registry import query
from panelweave.session import cut, new_path
from panelweave.sinks import writers
from panelweave.sources import documents as doc_source
from panelweave.sources import observations, results


def _write_folder(spark, sf) -> str:
    """The three input files of a run, made from the given tables."""
    folder = new_path(spark, "input")
    panel = cut(i.panel_l(spark, sf), "panel")
    wide = reshape.pivot_panel(panel, ["entity", "indicator"], label="period")
    wide.withColumnsRenamed({"entity": "Country Code", "indicator": "Indicator Code"}).write.option(
        "header", True
    ).csv(f"{folder}/indicatorData.csv")
    dim = cut(i.dim_of(panel), "dim")
    dim.select(
        F.col("indicator").alias("Indicator Code"), F.col("name").alias("Indicator"),
        F.col("dataset").alias("Dataset"), F.col("category").alias("Category"),
    ).write.option("header", True).csv(f"{folder}/indicatorMeta.csv")
    dim.select(
        F.col("dataset").alias("Dataset Code"), F.concat(F.lit("Set "), "dataset").alias("Dataset Name")
    ).distinct().write.option("header", True).csv(f"{folder}/datasetMeta.csv")
    return folder


@query("select * from panel_l", "panel_l")
def scan_wide(spark, sf):
    panel, _, _ = observations.import_panel(spark, _write_folder(spark, sf))
    return panel.withColumn("entity", F.col("entity").cast("long"))


@query("""select d.indicator, d.name, d.dataset, 'Set ' || d.dataset as dataset_name, d.category
from dim_l d where d.name is not null""", "dim_l")
def scan_meta(spark, sf):
    _, indicators, datasets = observations.import_panel(spark, _write_folder(spark, sf))
    return indicators.join(datasets.withColumnRenamed("name", "dataset_name"), "dataset")


def _write_results(spark, sf):
    """(folder of the stored matrices, dimension of their indicators)."""
    root = new_path(spark, "results")
    filled, importance, dim = given_results(spark, sf)
    writers.write_matrices(filled, importance.withColumnRenamed("indicator", "target"), root)
    return root, dim


@query("select distinct dataset, period from cells_l", "cells_l")
def scan_result_dir(spark, sf):
    return results.scan_result_dir(spark, _write_results(spark, sf)[0])


@query("select dataset, period, entity, indicator, value, lower, upper from cells_l", "cells_l")
def scan_results(spark, sf):
    read = results.scan_results(spark, _write_results(spark, sf)[0]).where("value is not null")
    return read.withColumn("entity", F.col("entity").cast("long"))


@query("""select d.dataset, t.period, t.target, t.feature, t.value
from importance_given t join dim_l d on t.target = d.indicator""", "importance_given dim_l")
def sink_matrix(spark, sf):
    return results.scan_importance(spark, _write_results(spark, sf)[0]).drop("line")


@query("select 'mean' as model, entity, indicator, period, prediction, lower, upper from pred_given", "pred_given")
def sink_raw(spark, sf):
    given = i.pred_given(i.panel_l(spark, sf), i.focus_l(spark, sf)).withColumn("model", F.lit("mean"))
    path = new_path(spark, "raw")
    writers.write_raw(given.where("period < 1998"), path)
    writers.write_raw(given.where("period >= 1998"), path)
    writers.write_raw(given.where("period = 2000"), path, append=False)  # a rerun adds nothing
    return spark.read.parquet(path)


def _read_documents(spark, root):
    read = docs.flatten_documents(doc_source.scan_documents(spark, root))
    return read.where("key is not null").withColumn("value", F.round("value", 9))


@query("select * from docs_l", "docs_l")
def sink_docs(spark, sf):
    root = new_path(spark, "documents")
    writers.write_documents(given_documents(spark, sf), root, "model1")
    return _read_documents(spark, root)


@query("""select dataset, indicator, part, period, key, value + case when period >= 2000 then 1 else 0 end as value
from docs_l""", "docs_l")
def scan_docs(spark, sf):
    root = new_path(spark, "documents")
    given = given_documents(spark, sf)
    writers.write_documents(given, root, "model1")
    again = given.where("period >= 2000").withColumn("value", F.col("value") + 1)
    writers.write_documents(again, root, "model1", "update")
    return _read_documents(spark, root)


@query("""select dataset, indicator, part, count(distinct period) as periods, count(*) as entries
from docs_l group by 1, 2, 3""", "docs_l")
def build_docs(spark, sf):
    nested = docs.nest_documents(given_documents(spark, sf))
    parts = F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(f"document.{p}").alias("m")) for p in docs.PARTS
    ])).alias("p")
    return nested.select("dataset", "indicator", parts).select(
        "dataset", "indicator", "p.part",
        F.size("p.m").cast("long").alias("periods"),
        F.aggregate(F.map_values("p.m"), F.lit(0).cast("long"), lambda a, m: a + F.size(m)).alias("entries"),
    ).where("entries > 0")


@query("select * from docs_l", "docs_l")
def restructure(spark, sf):
    (root, dim), out = _write_results(spark, sf), new_path(spark, "documents")
    restructure_results(spark, root, dim, out, "model1")
    return _read_documents(spark, out)


@query("""select distinct 'Model ' || category as model, 'mean fill' as approach, 'Mean of ' || category as name from dim_l""",
       "dim_l")
def model_metadata(spark, sf):
    path = new_path(spark, "metadata")
    for category in reshape.column_labels(i.dim_of(i.panel_l(spark, sf)), "category"):
        for name in ("draft", f"Mean of {category}"):
            writers.write_model_metadata(
                spark, path, f"Model {category}", {"Modelling Approach": "mean fill", "Model Name": name}
            )
    return doc_source.scan_model_metadata(spark, path).select(
        "model", F.col("Modelling Approach").alias("approach"), F.col("Model Name").alias("name")
    )


