"""Prediction intervals on given tables: votes and leaves of five trees, residuals of means."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import intervals
from panelweave.queries import inputs as i
from panelweave.queries.cells import _scored, rounded
from panelweave.queries.registry import query
from panelweave.session import cut

LEAF = ["period", "target", "tree", "leaf"]
ROW = ["period", "target", "entity"]

i.SQL["leaves_l"] = """leaves_l as materialized (
  select period, indicator as target, entity, value as y, t.tree, (entity * (2 * t.tree + 3) + t.tree) % 7 as leaf
  from panel_l cross join (select unnest([0, 1, 2, 3, 4]) as tree) t)"""
i.SQL["rest_l"] = """rest_l as materialized (
  select period, indicator as target, entity, t.tree, (entity * (2 * t.tree + 3) + t.tree) % 7 as leaf
  from dense_l cross join (select unnest([0, 1, 2, 3, 4]) as tree) t where value is null)"""
i.NEEDS |= {"leaves_l": ["panel_l"], "rest_l": ["dense_l"]}


def _leaves(cells, *more):
    tree = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree")
    leaf = (F.col("entity") * (2 * F.col("tree") + 3) + F.col("tree")) % 7
    return cells.select("period", F.col("indicator").alias("target"), "entity", *more, tree).withColumn("leaf", leaf)


def _given(spark, sf):
    panel = cut(i.panel_l(spark, sf), "panel")
    labels = _leaves(panel, F.col("value").alias("y"))
    rest = _leaves(i.dense_l(panel, i.focus_l(spark, sf)).where("value is null"))
    return labels, rest


@query("""select r.period, r.target, r.entity, round(avg(q.low), 4) as lower, round(avg(q.high), 4) as upper
from rest_l r join (select period, target, tree, leaf, quantile_cont(y, 0.05) low, quantile_cont(y, 0.95) high
                    from leaves_l group by 1, 2, 3, 4) q using (period, target, tree, leaf) group by 1, 2, 3""",
       "leaves_l rest_l")
def interval_leaf_quantile(spark, sf):
    labels, rest = _given(spark, sf)
    index = intervals.leaf_quantiles(labels, LEAF)
    return rounded(intervals.from_leaves(rest, ROW, index, LEAF), "lower", "upper", places=4)


@query("""select r.period, r.target, r.entity, round(avg(q.value), 4) as prediction, round(quantile_cont(q.value, 0.05), 4) as lower,
  round(quantile_cont(q.value, 0.95), 4) as upper
from rest_l r join (select period, target, tree, leaf, avg(y) as value from leaves_l group by 1, 2, 3, 4) q
  using (period, target, tree, leaf) group by 1, 2, 3""", "leaves_l rest_l")
def interval_trees(spark, sf):
    labels, rest = _given(spark, sf)
    votes = rest.join(labels.groupBy(*LEAF).agg(F.avg("y").alias("value")), LEAF)
    return rounded(intervals.across_trees(votes, ROW), "prediction", "lower", "upper", places=4)


@query("""select period, target, round(sum((tl - coalesce(lag_l, 0)) * residual), 2) as lower,
  round(sum((th - coalesce(lag_h, 0)) * residual), 2) as upper
from (
  select *, lag(tl) over w lag_l, lag(th) over w lag_h from (
    select period, target, rn, residual, sum(mass * case when m >= 6 then 1.0 when m = 5 then 0.05 else 0 end) tl,
           sum(mass * case when m >= 96 then 1.0 when m = 95 then 0.95 else 0 end) th
    from (
      select r.*, b.m, case when rn = n then (case when b.m = 100 then 1.0 else 0.0 end)
             else exp(lgamma(101) - lgamma(b.m + 1) - lgamma(101 - b.m) + b.m * ln(rn / n) + (100 - b.m) * ln(1 - rn / n)) end as mass
      from (select period, target, y - prediction as residual,
                   cast(row_number() over (partition by period, target order by y - prediction) as double) rn,
                   cast(count(*) over (partition by period, target) as double) n from scored_l) r
      cross join (select unnest(generate_series(0, 100)) as m) b where n >= 2)
    group by 1, 2, 3, 4)
  window w as (partition by period, target order by rn))
group by 1, 2""", "panel_l scored_l")
def interval_bootstrap(spark, sf):
    residuals = _scored(spark, sf).withColumn("residual", F.col("y") - F.col("prediction"))
    return rounded(intervals.bootstrap_offsets(residuals, ["period", "target"]), "lower", "upper", places=2)
