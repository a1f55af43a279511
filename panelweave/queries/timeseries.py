"""The time-series run in two forms: one predictor with two lags held to SQL, and all valid predictors with three lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import profile
from panelweave.plans import timeseries as plan
from panelweave.queries import inputs as i
from panelweave.queries.cells import _targets_e, extent, rounded, span
from panelweave.queries.multi import RIDGES
from panelweave.queries.registry import query
from panelweave.session import cut

i.SQL["ts_panel"] = """ts_panel as materialized (select * from panel_e where entity in (select entity from focus_e))"""
i.SQL["ts_filled"] = """ts_filled as materialized (
  select entity, indicator, cast(g.p as int) period,
         case when g.p > s.period and s.nxt is not null
              then s.value + (s.nxt_value - s.value) / (s.nxt - s.period) * (g.p - s.period) else s.value end as value
  from (select *, lag(period) over w prv, lead(period) over w nxt, lead(value) over w nxt_value
        from ts_panel window w as (partition by entity, indicator order by period)) s, days g
  where (g.p >= s.period or s.prv is null) and (g.p < s.nxt or s.nxt is null))"""
i.SQL["ts_near"] = """ts_near as materialized (
  select target, predictor from (
    select *, row_number() over (partition by target order by strength desc, predictor) rn from (
      select a.indicator target, b.indicator predictor, round(abs(
        (sum(a.value * b.value) - sum(a.value) * sum(b.value) / count(*))
        / sqrt((sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)))), 9) strength
      from ts_panel a join ts_panel b on a.period = b.period and a.entity = b.entity and a.indicator <> b.indicator
      group by 1, 2
      having count(*) >= 10 and (sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)) > 0)) where rn = 1)"""
i.SQL["ts_rows"] = """ts_rows as materialized (
  select k.target, f.entity, d.p as win, y.value as y, a.value as v1, b.value as v2, fold, third
  from ts_near k cross join (select entity, ntile(5) over (order by entity) - 1 as fold, ntile(3) over (order by entity) - 1 as third
                             from (select distinct entity from focus_e)) f cross join days d
  left join ts_panel y on y.entity = f.entity and y.indicator = k.target and y.period = d.p
  left join ts_filled a on a.entity = f.entity and a.indicator = k.predictor and a.period = d.p - 1
  left join ts_filled b on b.entity = f.entity and b.indicator = k.predictor and b.period = d.p - 2)"""
i.SQL["ts_tasks"] = """ts_tasks as materialized (
  select t.period, t.indicator as target, w.w as win, cast(1 as double) / (1 + t.period - w.w) as w
  from (select distinct period, indicator from panel_e where period >= (select min(p) from days) + 15) t
  join days w(w) on w.w between greatest((select min(p) from days), t.period - 15) + 2 and t.period)"""
i.SQL["ts_fill"] = """ts_fill as materialized (
  select period, target, coalesce(avg(v1), 0) f1, coalesce(avg(v2), 0) f2
  from ts_rows join ts_tasks using (target, win) where y is not null group by 1, 2)"""
i.SQL["ts_train"] = """ts_train as materialized (
  select period, target, entity, win, y, coalesce(v1, f1) x1, coalesce(v2, f2) x2, w, fold, third
  from ts_rows join ts_tasks using (target, win) join ts_fill using (period, target) where y is not null)"""
i.NEEDS |= {
    "ts_panel": ["panel_e", "focus_e", "days"], "ts_filled": ["ts_panel"], "ts_near": ["ts_filled"], "ts_rows": ["ts_near"],
    "ts_tasks": ["ts_rows"], "ts_fill": ["ts_tasks"], "ts_train": ["ts_fill"],
}
for _name in ("moments", "scaled", "fits", "grid", "best", "model", "resid"):
    i.SQL[f"ts_{_name}"] = i.SQL[f"lm_{_name}"].replace("lm_", "ts_")
    i.NEEDS[f"ts_{_name}"] = [n.replace("lm_", "ts_") for n in i.NEEDS[f"lm_{_name}"]]


def _one(spark, sf):
    panel = cut(i.panel_e(spark, sf), "panel")
    return plan.time_series(panel, i.focus_e(spark, sf), _targets_e(panel), *extent(panel), k=1, lag=2, penalties=RIDGES)


def _all(spark, sf):
    """Valid targets and predictors of each period, ten predictors at most, three lags."""
    panel, focus = cut(i.panel_e(spark, sf), "panel"), i.focus_e(spark, sf)
    seen = panel.join(focus, "entity", "left_semi")
    targets, about = span(panel)
    size = focus.select(F.count_distinct("entity")).first()[0]
    limits = {"focus_limit": size + 1, "limit": 0.999, **about}
    valid = profile.predictor_validity(seen, focus, *targets, **limits)
    wanted = profile.target_validity(seen, focus, *targets, **limits)
    return plan.time_series(panel, focus, cut(wanted, "targets"), *extent(panel), valid=cut(valid, "valid"))


@query("""select period, target, cast(n as double) as n, alpha, round(intercept, 1) as intercept, round(c1, 6) as first,
  round(c2, 6) as second from ts_model""", "ts_model")
def time_series_model(spark, sf):
    c = F.col("coefficients")
    out = _one(spark, sf).model.select("period", "target", "n", "alpha", "intercept", c[0].alias("first"), c[1].alias("second"))
    return rounded(rounded(out, "first", "second"), "intercept", places=1)


@query("""select r.period, r.target, r.entity, round(p, 1) as prediction, round(p + low, 1) as lower, round(p + high, 1) as upper
from (select m.period, m.target, r.entity, intercept + c1 * coalesce(v1, f1) + c2 * coalesce(v2, f2) as p
      from ts_rows r join ts_model m on m.target = r.target and m.period = r.win
      join ts_fill f on f.period = m.period and f.target = m.target where r.y is null) r
join (select period, target, quantile_cont(residual, 0.05) low, quantile_cont(residual, 0.95) high
      from ts_resid group by 1, 2) q using (period, target)""", "ts_model ts_resid")
def time_series_linear(spark, sf):
    return rounded(_one(spark, sf).predictions, "prediction", "lower", "upper", places=1)


@query("""select period, target, round(rmse, 2) as rmse,
  round(case when rmse / m between 0 and 1 then rmse / m else rmse / s end, 8) as nrmse, round(r2, 8) as r2
from ts_best join (select period, target, avg(y) m, max(y) - min(y) s,
  1 - sum(residual * residual) / nullif(count(*) * var_pop(y), 0) r2 from ts_resid group by 1, 2) using (period, target)""",
       "ts_best ts_resid")
def time_series_performance(spark, sf):
    return rounded(rounded(plan.performance(_one(spark, sf)), "rmse", places=2), "nrmse", "r2", places=8)


@query()
def time_series(spark, sf):
    return _all(spark, sf).predictions


@query()
def time_series_importances(spark, sf):
    return plan.importances(_all(spark, sf))
