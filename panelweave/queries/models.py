"""Penalised linear models of all targets, with their search, residuals, bands and scores; trees of one."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import pairs, profile, ranking, trees
from panelweave.plans.linear import predictions, year_by_year
from panelweave.queries import inputs as i
from panelweave.queries.cells import rounded
from panelweave.queries.registry import query
from panelweave.session import cut

i.SQL["lin_choice"] = """lin_choice as (
  select period, target, predictor, strength from (
    select *, row_number() over (partition by period, target order by strength desc, predictor) rn from (
      select a.period, a.indicator target, b.indicator predictor, round(abs(
        (sum(a.value * b.value) - sum(a.value) * sum(b.value) / count(*))
        / sqrt((sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)))), 9) strength
      from panel_l a join panel_l b on a.period = b.period and a.entity = b.entity and a.indicator <> b.indicator
      group by 1, 2, 3
      having count(*) >= 10 and (sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)) > 0))
  where rn = 1)"""
i.SQL["lin_train"] = """lin_train as (
  select c.period, c.target, y.entity, x.value as x, y.value as y,
         ntile(5) over (partition by c.period, c.target order by y.entity) - 1 as fold
  from lin_choice c join panel_l y on y.period = c.period and y.indicator = c.target
  join panel_l x on x.period = c.period and x.indicator = c.predictor and x.entity = y.entity)"""
i.SQL["lin_lines"] = """lin_lines as (
  select period, target, fold, penalty, slope, my - slope * mx as intercept from (
    select t.period, t.target, f.fold, p.penalty, regr_slope(t.y, t.x) / (1 + p.penalty) as slope, avg(t.x) mx, avg(t.y) my
    from lin_train t cross join (select unnest([0, 1, 2, 3, 4, 9]) as fold) f
    cross join (select unnest([0.0, 0.1, 1.0]::double[]) as penalty) p
    where t.fold <> f.fold group by 1, 2, 3, 4))"""
i.SQL["lin_oof"] = """lin_oof as (
  select t.period, t.target, t.entity, t.fold, l.penalty, t.y, l.slope * t.x + l.intercept as prediction
  from lin_train t join lin_lines l using (period, target, fold))"""
i.SQL["lin_grid"] = """lin_grid as (
  select period, target, penalty, sqrt(avg(mse)) as rmse from (
    select period, target, penalty, fold, avg((y - prediction) * (y - prediction)) mse from lin_oof group by 1, 2, 3, 4)
  group by 1, 2, 3)"""
i.SQL["lin_best"] = """lin_best as (
  select period, target, penalty, rmse from (
    select *, row_number() over (partition by period, target order by round(rmse, 6), penalty) rn from lin_grid)
  where rn = 1)"""
i.SQL["lin_resid"] = """lin_resid as (
  select o.*, y - prediction as residual from lin_oof o join lin_best b using (period, target, penalty))"""
i.SQL["lin_model"] = """lin_model as (
  select l.period, l.target, l.penalty, l.slope, l.intercept,
         (select count(*) from lin_train t where t.period = l.period and t.target = l.target) as n
  from lin_lines l join lin_best b using (period, target, penalty) where l.fold = 9)"""
i.NEEDS |= {
    "lin_choice": ["panel_l"], "lin_train": ["lin_choice"], "lin_lines": ["lin_train"], "lin_oof": ["lin_lines"],
    "lin_grid": ["lin_oof"], "lin_best": ["lin_grid"], "lin_resid": ["lin_best"], "lin_model": ["lin_best"],
}


def _run(spark, sf):
    return year_by_year(i.panel_l(spark, sf))


@query("select period, target, predictor, round(strength, 6) as strength from lin_choice", "lin_choice")
def linear_predictor(spark, sf):
    return rounded(_run(spark, sf).chosen, "strength")


@query("select period, target, penalty, round(rmse, 2) as rmse from lin_grid", "lin_grid")
def grid_search(spark, sf):
    return rounded(_run(spark, sf).grid, "rmse", places=2)


@query("""select period, target, n, penalty, round(slope, 6) as slope, round(intercept, 1) as intercept from lin_model""",
       "lin_model")
def model_linear(spark, sf):
    return rounded(rounded(_run(spark, sf).model, "slope"), "intercept", places=1)


@query("""select period, target, entity, cast(fold as int) as fold, penalty, round(residual, 2) as residual from lin_resid""",
       "lin_resid")
def oof_residuals(spark, sf):
    out = _run(spark, sf).residuals.select("period", "target", "entity", "fold", "penalty", "residual")
    return rounded(out, "residual", places=2)


@query("""select period, target, round(rmse, 2) as rmse,
  round(case when rmse / m between 0 and 1 then rmse / m else rmse / s end, 8) as nrmse
from lin_best join (select period, target, avg(y) m, max(y) - min(y) s from lin_resid group by 1, 2) using (period, target)""",
       "lin_best lin_resid")
def performance(spark, sf):
    return rounded(rounded(_run(spark, sf).performance, "rmse", places=2), "nrmse", places=8)


@query("""select c.period, c.target, x.entity, round(m.slope * x.value + m.intercept, 1) as prediction,
  round(m.slope * x.value + m.intercept + q.low, 1) as lower, round(m.slope * x.value + m.intercept + q.high, 1) as upper
from lin_choice c join panel_l x on x.period = c.period and x.indicator = c.predictor
join lin_model m on m.period = c.period and m.target = c.target
join (select period, target, quantile_cont(residual, 0.05) low, quantile_cont(residual, 0.95) high
      from lin_resid group by 1, 2) q on q.period = c.period and q.target = c.target
where x.entity in (select entity from focus_l)
  and not exists (select 1 from panel_l y where y.period = c.period and y.indicator = c.target and y.entity = x.entity)""",
       "lin_model lin_resid focus_l")
def year_by_year_linear(spark, sf):
    panel = i.panel_l(spark, sf)
    out = predictions(year_by_year(panel), panel, i.focus_l(spark, sf))
    return rounded(out, "prediction", "lower", "upper", places=1)


def _one_target(spark, sf):
    """Rows of the target with most missing cells, its four most correlated predictors as columns."""
    panel = cut(i.panel_l(spark, sf), "panel")
    order = [F.col("percent_missing").desc(), "period", "indicator"]
    period, target = (
        profile.rank_indicators(profile.missingness(panel), 90).orderBy(*order).select("period", "indicator").first()
    )
    there = panel.where(F.col("period") == period)
    near = pairs.nearest_features(pairs.pair_stats(there, ["period"], "entity"), ["period"], 4)
    names = [r[0] for r in near.where(F.col("target") == target).orderBy("rank").select("predictor").collect()]
    wide = there.groupBy("entity").pivot("indicator", [target, *names]).agg(F.first("value"))
    features = [f"x{k}" for k in range(len(names))]
    rows = wide.toDF("entity", "y", *features)
    rows = rows.where(" or ".join(f"{c} is not null" for c in features))
    labelled = ranking.kfold(rows.where("y is not null").withColumn("k", F.lit(0)), ["k"], ["entity"], 5).drop("k")
    rest = rows.where("y is null").withColumn("fold", F.lit(0))
    return cut(labelled.unionByName(rest), "one-target"), features


def _trained(spark, sf, family):
    rows, features = _one_target(spark, sf)
    return trees.train(rows, features, family)


@query()
def model_forest(spark, sf):
    return _trained(spark, sf, "forest").predictions


@query()
def model_boosting(spark, sf):
    return _trained(spark, sf, "boosting").predictions


@query()
def importances(spark, sf):
    return _trained(spark, sf, "forest").importances
