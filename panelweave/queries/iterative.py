"""Chained imputation and the iterative run; two rounds of two neighbours held to SQL."""

from __future__ import annotations

from panelweave.operators import chained, rows
from panelweave.plans import iterative as plan
from panelweave.queries import inputs as i
from panelweave.queries.cells import rounded
from panelweave.queries.registry import query


def _chain(name: str, where: str) -> None:
    """SQL of two rounds, of the last round's models for each fold, and of the report."""
    sql = {
        "rows": f"""select entity, period, ntile(3) over (order by entity, period) - 1 as third
  from (select distinct entity, period from panel_l {where})""",
        "s0": f"""select r.entity, r.period, r.third, c.indicator, p.value is not null as seen, coalesce(p.value, c.mean) as value
  from {name}_rows r cross join (select indicator, avg(value) mean from panel_l {where} group by 1) c
  left join panel_l p on p.entity = r.entity and p.period = r.period and p.indicator = c.indicator""",
        "near": f"""select target, max(case when rn = 1 then predictor end) p1, max(case when rn = 2 then predictor end) p2 from (
    select *, row_number() over (partition by target order by strength desc, predictor) rn from (
      select a.indicator target, b.indicator predictor,
             coalesce(round(abs(case when isfinite(corr(a.value, b.value)) then corr(a.value, b.value) end), 9), 0) strength
      from {name}_s0 a join {name}_s0 b on a.entity = b.entity and a.period = b.period and a.indicator <> b.indicator
      group by 1, 2)) where rn <= 2 group by 1""",
    }
    for n in (1, 2):
        before = f"{name}_s{n - 1}"
        sql[f"x{n}"] = f"""select y.*, coalesce(a.value, 0) x1, coalesce(b.value, 0) x2 from {before} y join {name}_near k on k.target = y.indicator
  left join {before} a on a.entity = y.entity and a.period = y.period and a.indicator = k.p1
  left join {before} b on b.entity = y.entity and b.period = y.period and b.indicator = k.p2"""
        sql[f"m{n}"] = f"""select indicator, f, my - c1 * m1 - c2 * m2 as intercept, c1, c2 from (
    select *, coalesce((1.001 * r1 - r12 * r2) / (1.001 * 1.001 - r12 * r12) * sy / nullif(s1, 0), 0) c1,
           coalesce((1.001 * r2 - r12 * r1) / (1.001 * 1.001 - r12 * r12) * sy / nullif(s2, 0), 0) c2 from (
      select *, coalesce((q12 - m1 * m2) / nullif(s1 * s2, 0), 0) r12, coalesce((q1y - m1 * my) / nullif(s1 * sy, 0), 0) r1,
             coalesce((q2y - m2 * my) / nullif(s2 * sy, 0), 0) r2 from (
        select *, case when q1 - m1 * m1 > 1e-12 * q1 then sqrt(q1 - m1 * m1) else 0 end s1,
               case when q2 - m2 * m2 > 1e-12 * q2 then sqrt(q2 - m2 * m2) else 0 end s2,
               case when qy - my * my > 1e-12 * qy then sqrt(qy - my * my) else 0 end sy from (
          select indicator, f, avg(x1) m1, avg(x2) m2, avg(value) my, avg(x1 * x1) q1, avg(x2 * x2) q2, avg(value * value) qy,
                 avg(x1 * x2) q12, avg(x1 * value) q1y, avg(x2 * value) q2y
          from {name}_x{n} cross join (select unnest([-1, 0, 1, 2]) f) where seen and third <> f group by 1, 2))))"""
        sql[f"s{n}"] = f"""select entity, period, third, indicator, seen,
         case when seen then value else intercept + c1 * x1 + c2 * x2 end as value
  from {name}_x{n} join {name}_m{n} using (indicator) where f = -1"""
    sql["left"] = f"""select indicator, value as y, value - intercept - c1 * x1 - c2 * x2 as residual
  from {name}_x2 x join {name}_m2 m using (indicator) where seen and f = third"""
    sql["report"] = f"""select indicator, n, rmse, case when rmse / m between 0 and 1 then rmse / m else rmse / s end as nrmse, r2, low, high
  from (select indicator, count(*) n, sqrt(avg(residual * residual)) rmse, avg(y) m, nullif(max(y) - min(y), 0) s,
               1 - sum(residual * residual) / nullif(count(*) * var_pop(y), 0) r2,
               quantile_cont(residual, 0.05) low, quantile_cont(residual, 0.95) high from {name}_left group by 1)"""
    previous = "panel_l"
    for key, body in sql.items():
        i.SQL[f"{name}_{key}"] = f"{name}_{key} as materialized (\n  {body})"
        i.NEEDS[f"{name}_{key}"] = [previous]
        previous = f"{name}_{key}"


_chain("ch", "")
_chain("it", "where period >= 1996 and period < 2001")


def _two_rounds(panel):
    return chained.impute(panel, k=2, rounds=2, tol=0.0)


@query("select entity, period, indicator, round(value, 1) as value, not seen as is_imputed from ch_s2", "ch_s2")
def chained_impute(spark, sf):
    return rounded(chained.cells(_two_rounds(i.panel_l(spark, sf))), "value", places=1)


@query("""select indicator, n, round(rmse, 2) as rmse, round(nrmse, 8) as nrmse, round(r2, 8) as r2, round(low, 2) as low,
  round(high, 2) as high from ch_report""", "ch_report")
def chained_report(spark, sf):
    out = plan.report(_two_rounds(i.panel_l(spark, sf)))
    return rounded(rounded(out, "rmse", "low", "high", places=2), "nrmse", "r2", places=8)


@query("""select entity, period, indicator, round(value, 1) as value, case when not seen then round(value + low, 1) end as lower,
  case when not seen then round(value + high, 1) end as upper, not seen as is_imputed
from it_s2 left join it_report using (indicator) where entity in (select entity from focus_l)""", "it_report focus_l")
def iterative(spark, sf):
    run = _two_rounds(rows.period_range(i.panel_l(spark, sf), 1996, 2001))
    out = plan.predictions(run, plan.report(run), i.focus_l(spark, sf))
    return rounded(out, "value", "lower", "upper", places=1)


@query()
def iterative_converged(spark, sf):
    """Ten neighbours, until cells change by less than a thousandth of the largest value."""
    run = chained.impute(i.panel_l(spark, sf))
    return plan.predictions(run, plan.report(run))


@query()
def chained_importances(spark, sf):
    return chained.importances(chained.impute(i.panel_l(spark, sf), rounds=2))
