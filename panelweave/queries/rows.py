"""Filters, label sets, reshapes, keys and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import pair_key, result_name_parts, safe_name
from panelweave.operators import profile, reshape, rows
from panelweave.operators.pairs import pair_stats
from panelweave.queries import inputs as i
from panelweave.queries.registry import query
from panelweave.session import cut

i.NEEDS |= {
    "keyed": ["panel_l"], "targets": ["panel_l"], "large_l": ["dense_l"], "predictors": ["panel_l"], "sparse": ["panel_e"],
}
# Cells with null keys, for the key operators.
i.SQL["keyed"] = """keyed as (
  select case when period = 1995 then null else entity end entity,
         case when indicator like '%-N' then null else indicator end indicator, period, value from panel_l)"""


def _keyed(spark, sf):
    return i.panel_l(spark, sf).select(
        F.when(F.col("period") != 1995, F.col("entity")).alias("entity"),
        F.when(~F.col("indicator").like("%-N"), F.col("indicator")).alias("indicator"),
        "period",
        "value",
    )


@query("select * from keyed where entity is not null and indicator is not null", "panel_l keyed")
def drop_null_keys(spark, sf):
    return rows.drop_null_keys(_keyed(spark, sf), "entity", "indicator")


@query("""select period, cast(entity as varchar) || '-' || indicator as pair, count(*) as cells
from keyed group by 1, 2""", "panel_l keyed")
def pair_key_cells(spark, sf):
    key = pair_key(F.col("entity").cast("string"), F.col("indicator"))
    return _keyed(spark, sf).groupBy("period", key.alias("pair")).agg(F.count("*").alias("cells"))


@query("select * from dim_l where name is not null", "dim_l")
def meta_filter(spark, sf):
    return rows.named_rows(i.dim_of(i.panel_l(spark, sf)), "name")


@query("select * from dim_l where indicator in (select indicator from panel_l where period = 2001)", "dim_l")
def meta_semi(spark, sf):
    panel = i.panel_l(spark, sf)
    return rows.used_rows(i.dim_of(panel), rows.cross_section(panel, 2001), "indicator")


@query("select * from panel_l where entity in (select entity from focus_l)", "panel_l focus_l")
def focus_filter(spark, sf):
    return rows.in_focus(i.panel_l(spark, sf), i.focus_l(spark, sf))


@query("select * from panel_l where period = 1998", "panel_l")
def cross_section(spark, sf):
    return rows.cross_section(i.panel_l(spark, sf), 1998)


@query("select * from panel_l where period >= 1996 and period < 1999", "panel_l")
def period_range(spark, sf):
    return rows.period_range(i.panel_l(spark, sf), 1996, 1999)


@query("select * from panel_e where period between greatest(1, 20 - 15) and 20", "panel_e")
def history_slice(spark, sf):
    return rows.history_slice(i.panel_e(spark, sf), 20, 15, 1)


@query("""select * from panel_l where entity in (select entity from focus_l)
and period >= 1996 and period < 2000""", "panel_l focus_l")
def focus_period_slice(spark, sf):
    return rows.period_range(rows.in_focus(i.panel_l(spark, sf), i.focus_l(spark, sf)), 1996, 2000)


i.SQL["targets"] = """targets as (
  select period, indicator from (
    select period, indicator, (select count(distinct entity) from panel_l) n, count(value) c
    from panel_l group by 1, 2) where (n - c) * 100.0 / n > 0 and (n - c) * 100.0 / n < 90)"""


def _targets(panel, percent=90):
    return profile.rank_indicators(profile.missingness(panel), percent).select("period", "indicator")


@query("""select period, indicator as target, entity, value as y,
  entity in (select entity from focus_l) as in_focus
from panel_l join targets using (period, indicator)""", "panel_l focus_l targets")
def train_split(spark, sf):
    panel = i.panel_l(spark, sf)
    return rows.train_split(panel, _targets(panel), i.focus_l(spark, sf))


@query("""select period, indicator as target, entity
from dense_l join targets using (period, indicator) where value is null""", "dense_l targets")
def predict_split(spark, sf):
    panel = i.panel_l(spark, sf)
    targets = _targets(panel)
    cells = reshape.densify(panel, i.focus_l(spark, sf), targets, ["period", "indicator"])
    return rows.predict_split(cells)


# Only large values count here, so that whole rows and columns are empty.
i.SQL["large_l"] = """large_l as materialized (
  select entity, indicator, period, case when value >= 9000000 then value end as value from dense_l)"""


def _large(spark, sf):
    cells = i.dense_l(i.panel_l(spark, sf), i.focus_l(spark, sf))
    return cells.withColumn("value", F.when(F.col("value") >= 9000000, F.col("value")))


@query("""select l.entity, l.indicator, l.period, l.value from large_l l join (
  select entity, indicator from large_l group by entity, indicator having count(value) > 0) seen
  on seen.entity = l.entity and seen.indicator = l.indicator""", "dense_l large_l")
def drop_all_null_rows(spark, sf):
    return rows.drop_all_null_rows(_large(spark, sf))


@query("""select l.entity, l.indicator, l.period, l.value from large_l l join (
  select indicator from large_l group by indicator having count(value) > 0) seen on seen.indicator = l.indicator""",
       "dense_l large_l")
def drop_all_null_cols(spark, sf):
    return rows.drop_all_null_columns(_large(spark, sf), "indicator")


i.SQL["predictors"] = """joint as (
  select a.period, a.indicator target, b.indicator predictor, count(*) n
  from panel_l a join panel_l b on a.period = b.period and a.entity = b.entity group by 1, 2, 3),
predictors as (
  select j.period, j.target, j.predictor, (d.n - j.n) * 100.0 / d.n as percent_missing
  from joint j join joint d on d.period = j.period and d.target = j.target and d.predictor = j.target
  where j.target <> j.predictor and (d.n - j.n) * 100.0 / d.n < 40)"""


@query("""select period, target, predictor, round(cast(percent_missing as double), 6) as percent_missing
from predictors""", "panel_l predictors")
def predictor_filter(spark, sf):
    counts = pair_stats(i.panel_l(spark, sf), ["period"], "entity")
    kept = profile.predictors_on_train_rows(counts, 40)
    return kept.withColumn("percent_missing", F.round("percent_missing", 6))


@query("""select t.period, t.indicator as target, p.indicator as predictor
from targets t join pairs_l p on t.period = p.period and t.indicator <> p.indicator""", "pairs_l targets")
def predictors_minus_target(spark, sf):
    panel = i.panel_l(spark, sf)
    predictors = panel.select("period", F.col("indicator").alias("predictor")).distinct()
    return (
        _targets(panel).withColumnRenamed("indicator", "target")
        .join(predictors, "period").where("target <> predictor")
    )


@query("""select entity, indicator as feature, period, value from panel_l""", "panel_l")
def normalise_labels(spark, sf):
    stored = i.panel_l(spark, sf).select(
        "entity", F.col("indicator").alias("names"), F.col("period").cast("string").alias("year"), "value"
    )
    return rows.normalise_labels(stored, "year", {"names": "feature"})


i.SQL["sparse"] = """sparse as (
  select indicator from (
    select entity, indicator, (n - count(value)) * 100.0 / n as pm
    from panel_e, (select count(distinct period) n from panel_e) group by entity, indicator, n)
  group by 1 having min(pm) >= 60)"""


@query("select * from panel_e where indicator not in (select indicator from sparse)", "panel_e sparse")
def series_screen(spark, sf):
    return profile.series_screen(i.panel_e(spark, sf), 60)


@query("""select p.*, d.dataset from pred_given p join dim_l d using (indicator)""", "pred_given dim_l")
def dataset_lookup(spark, sf):
    panel = i.panel_l(spark, sf)
    given = i.pred_given(panel, i.focus_l(spark, sf))
    return rows.lookup(given, i.dim_of(panel), "indicator", "dataset")


def _wide(spark, sf):
    panel = cut(i.panel_l(spark, sf), "panel")
    periods = reshape.column_labels(panel, "period")
    return reshape.pivot_panel(panel, ["entity", "indicator"], periods, label="period"), periods


@query("select entity, indicator, period, value from panel_l", "panel_l")
def unpivot(spark, sf):
    wide, periods = _wide(spark, sf)
    return reshape.unpivot(wide, ["entity", "indicator"], periods)


@query("""select s.entity, s.indicator, g.period, l.value
from (select distinct entity, indicator from panel_l) s
cross join (select distinct period from panel_l) g
left join panel_l l on l.entity = s.entity and l.indicator = s.indicator and l.period = g.period""", "panel_l")
def unpivot_keep(spark, sf):
    wide, periods = _wide(spark, sf)
    return reshape.unpivot(wide, ["entity", "indicator"], periods, keep_nulls=True)


# SQL views need their columns named: every brand with every return flag.
_COLUMNS = ", ".join(f"'Brand#{k}-{flag}'" for k in range(1, 26) for flag in "ANR")


@query(f"select * from (pivot panel_l on indicator in ({_COLUMNS}) using first(value) group by entity, period)", "panel_l")
def pivot_panel(spark, sf):
    return reshape.pivot_panel(cut(i.panel_l(spark, sf), "panel"))


@query("select * from dense_l", "dense_l")
def densify(spark, sf):
    return i.dense_l(i.panel_l(spark, sf), i.focus_l(spark, sf))


@query("select dataset, list(distinct indicator order by indicator) as members from dim_l group by 1",
       "dim_l")
def dataset_members(spark, sf):
    return rows.members(i.dim_of(i.panel_l(spark, sf)), "dataset", "indicator")


@query("""select distinct d.dataset, p.period from panel_l p join dim_l d using (indicator)""", "dim_l")
def distinct_keys(spark, sf):
    panel = i.panel_l(spark, sf)
    return panel.join(i.dim_of(panel), "indicator").select("dataset", "period").distinct()


@query("""select l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey from (
  select *, row_number() over (partition by l_suppkey, l_returnflag
    order by l_shipdate, l_orderkey, l_linenumber) rn from lineitem) where rn = 1""")
def first_wins(spark, sf):
    columns = ["l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    return rows.first_row(
        i.table(spark, sf, "lineitem").select(*columns),
        ["l_suppkey", "l_returnflag"],
        ["l_shipdate", "l_orderkey", "l_linenumber"],
    ).select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")


@query("""select 'a' as model, entity, indicator, period, prediction, cast(null as double) as shift from pred_given
union all select 'b', entity, indicator, period, prediction + 1, 1.0 from pred_given""", "pred_given")
def union_predictions(spark, sf):
    given = i.pred_given(i.panel_l(spark, sf), i.focus_l(spark, sf)).drop("lower", "upper")
    a = given.withColumn("model", F.lit("a"))
    b = given.withColumns(
        {"model": F.lit("b"), "prediction": F.col("prediction") + 1, "shift": F.lit(1.0)}
    )
    return rows.append(a, b)


@query("""select indicator, dataset from dim_l
intersect select p.indicator, d.dataset from panel_l p join dim_l d using (indicator)
where p.entity in (select entity from focus_l)""", "dim_l focus_l")
def dataset_columns(spark, sf):
    panel = i.panel_l(spark, sf)
    columns = rows.in_focus(panel, i.focus_l(spark, sf))
    return rows.used_rows(i.dim_of(panel), columns, "indicator").select("indicator", "dataset")


@query("select indicator from panel_l union select indicator from panel_e", "panel_l panel_e")
def indicator_union(spark, sf):
    return rows.label_union("indicator", i.panel_l(spark, sf), i.panel_e(spark, sf))


@query("""select distinct 'results/model1/predictions/' || dataset || '_predictions_' || period || '.csv' as path,
  dataset, period from panel_l join dim_l using (indicator)""", "dim_l")
def parse_result_name(spark, sf):
    panel = i.panel_l(spark, sf)
    paths = panel.join(i.dim_of(panel), "indicator").select(
        F.concat(F.lit("results/model1/predictions/"), "dataset", F.lit("_predictions_"),
                 F.col("period").cast("string"), F.lit(".csv")).alias("path")
    ).distinct()
    dataset, period = result_name_parts("path")
    return paths.select("path", dataset.alias("dataset"), period.alias("period"))


@query("""select distinct indicator, replace(replace(indicator, '-', '/'), '/', ' ') as name from panel_l""",
       "panel_l")
def safe_names(spark, sf):
    labels = i.panel_l(spark, sf).select("indicator").distinct()
    return labels.select("indicator", safe_name(F.translate("indicator", "-", "/")).alias("name"))


@query("""select period, target, predictor from predictors
where predictor in (select indicator from dim_l where category = 'R')""", "dim_l predictors")
def manual_select(spark, sf):
    panel = i.panel_l(spark, sf)
    kept = profile.predictors_on_train_rows(pair_stats(panel, ["period"], "entity"), 40)
    chosen = i.dim_of(panel).where("category = 'R'").select(F.col("indicator").alias("predictor"))
    return rows.only(kept, chosen, "predictor").select("period", "target", "predictor")

