"""Linear models of several predictors for all targets, in two forms: two predictors held to SQL, ten with every penalty."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import design, gram, svr
from panelweave.operators.pairs import pair_stats
from panelweave.plans import multilinear
from panelweave.queries import inputs as i
from panelweave.queries.cells import rounded
from panelweave.queries.registry import query
from panelweave.session import cut

#: Ridges only, as SQL solves them for two predictors.
RIDGES = ((0.0, 0.0), (0.0, 0.1), (0.0, 1.0))

i.SQL["lm_rank"] = """lm_rank as materialized (
  select period, target, predictor, strength, rn from (
    select *, row_number() over (partition by period, target order by strength desc, predictor) rn from (
      select a.period, a.indicator target, b.indicator predictor, round(abs(
        (sum(a.value * b.value) - sum(a.value) * sum(b.value) / count(*))
        / sqrt((sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)))), 9) strength
      from panel_l a join panel_l b on a.period = b.period and a.entity = b.entity and a.indicator <> b.indicator
      group by 1, 2, 3
      having count(*) >= 10 and (sum(a.value * a.value) - sum(a.value) * sum(a.value) / count(*))
             * (sum(b.value * b.value) - sum(b.value) * sum(b.value) / count(*)) > 0))
  where rn <= 3)"""
i.SQL["lm_rows"] = """lm_rows as materialized (
  select c.period, c.target, e.entity, y.value as y, v1.value as v1, v2.value as v2, v3.value as v3,
         e.entity in (select entity from focus_l) as in_focus
  from (select period, target, max(case when rn = 1 then predictor end) p1, max(case when rn = 2 then predictor end) p2,
               max(case when rn = 3 then predictor end) p3 from lm_rank group by 1, 2) c
  join (select distinct period, entity from panel_l) e on e.period = c.period
  left join panel_l y on y.period = c.period and y.entity = e.entity and y.indicator = c.target
  left join panel_l v1 on v1.period = c.period and v1.entity = e.entity and v1.indicator = c.p1
  left join panel_l v2 on v2.period = c.period and v2.entity = e.entity and v2.indicator = c.p2
  left join panel_l v3 on v3.period = c.period and v3.entity = e.entity and v3.indicator = c.p3)"""
i.SQL["lm_fill"] = """lm_fill as materialized (
  select period, target, coalesce(avg(v1), 0) f1, coalesce(avg(v2), 0) f2, coalesce(avg(v3), 0) f3
  from lm_rows where y is not null group by 1, 2)"""
i.SQL["lm_train"] = """lm_train as materialized (
  select period, target, entity, y, coalesce(v1, f1) x1, coalesce(v2, f2) x2, coalesce(v3, f3) x3,
         1.0::double / count(*) over (partition by period, target, in_focus) as w,
         ntile(5) over (partition by period, target order by entity) - 1 as fold,
         ntile(3) over (partition by period, target order by entity) - 1 as third
  from lm_rows join lm_fill using (period, target) where y is not null)"""
i.SQL["lm_moments"] = """lm_moments as materialized (
  select t.period, t.target, s.split, s.f, count(*) n, sum(w) sw, sum(w * x1) / sum(w) m1, sum(w * x2) / sum(w) m2,
         sum(w * y) / sum(w) my, sum(w * x1 * x1) / sum(w) q1, sum(w * x2 * x2) / sum(w) q2, sum(w * y * y) / sum(w) qy,
         sum(w * x1 * x2) / sum(w) q12, sum(w * x1 * y) / sum(w) q1y, sum(w * x2 * y) / sum(w) q2y
  from lm_train t cross join (
    select 'fold' as split, unnest([0, 1, 2, 3, 4]) as f union all select 'third', unnest([0, 1, 2]) union all select 'all', -1) s
  where (s.split = 'fold' and t.fold <> s.f) or (s.split = 'third' and t.third <> s.f) or s.split = 'all'
  group by 1, 2, 3, 4)"""
i.SQL["lm_scaled"] = """lm_scaled as materialized (
  select *, coalesce((q12 - m1 * m2) / nullif(s1 * s2, 0), 0) r12, coalesce((q1y - m1 * my) / nullif(s1 * sy, 0), 0) r1,
         coalesce((q2y - m2 * my) / nullif(s2 * sy, 0), 0) r2
  from (select *, case when q1 - m1 * m1 > 1e-12 * q1 then sqrt(q1 - m1 * m1) else 0 end s1,
               case when q2 - m2 * m2 > 1e-12 * q2 then sqrt(q2 - m2 * m2) else 0 end s2,
               case when qy - my * my > 1e-12 * qy then sqrt(qy - my * my) else 0 end sy from lm_moments))"""
i.SQL["lm_fits"] = """lm_fits as materialized (
  select *, my - c1 * m1 - c2 * m2 as intercept from (
    select *, coalesce(b1 * sy / nullif(s1, 0), 0) c1, coalesce(b2 * sy / nullif(s2, 0), 0) c2 from (
      select *, ((1 + alpha) * r1 - r12 * r2) / ((1 + alpha) * (1 + alpha) - r12 * r12) b1,
             ((1 + alpha) * r2 - r12 * r1) / ((1 + alpha) * (1 + alpha) - r12 * r12) b2
      from lm_scaled cross join (select unnest([0.0, 0.1, 1.0]::double[]) as alpha))))"""
i.SQL["lm_grid"] = """lm_grid as materialized (
  select period, target, alpha, sqrt(avg(mse)) rmse from (
    select t.period, t.target, l.alpha, t.fold, avg((y - intercept - c1 * x1 - c2 * x2) * (y - intercept - c1 * x1 - c2 * x2)) mse
    from lm_train t join lm_fits l on l.period = t.period and l.target = t.target and l.split = 'fold' and l.f = t.fold
    group by 1, 2, 3, 4) group by 1, 2, 3)"""
i.SQL["lm_best"] = """lm_best as materialized (
  select period, target, alpha, rmse from (
    select *, row_number() over (partition by period, target order by round(rmse, 6), alpha) rn from lm_grid) where rn = 1)"""
i.SQL["lm_model"] = """lm_model as materialized (
  select l.* from lm_fits l join lm_best b using (period, target, alpha) where l.split = 'all')"""
i.SQL["lm_resid"] = """lm_resid as materialized (
  select t.period, t.target, t.entity, t.third, t.y, intercept + c1 * x1 + c2 * x2 as prediction,
         t.y - intercept - c1 * x1 - c2 * x2 as residual
  from lm_train t join lm_best b using (period, target)
  join lm_fits l on l.period = t.period and l.target = t.target and l.alpha = b.alpha and l.split = 'third' and l.f = t.third)"""
i.NEEDS |= {
    "lm_rank": ["panel_l"], "lm_rows": ["lm_rank", "focus_l"], "lm_fill": ["lm_rows"], "lm_train": ["lm_fill"],
    "lm_moments": ["lm_train"], "lm_scaled": ["lm_moments"], "lm_fits": ["lm_scaled"], "lm_grid": ["lm_fits"],
    "lm_best": ["lm_grid"], "lm_model": ["lm_best"], "lm_resid": ["lm_best"],
}


def _two(spark, sf):
    return multilinear.year_by_year(i.panel_l(spark, sf), i.focus_l(spark, sf), 2, RIDGES)


@query("""select period, target, cast(n as double) as n, alpha, round(intercept, 1) as intercept, round(c1, 6) as first,
  round(c2, 6) as second from lm_model""", "lm_model")
def model_linear_multi(spark, sf):
    c = F.col("coefficients")
    out = _two(spark, sf).model.select(
        "period", "target", "n", "alpha", "intercept", c[0].alias("first"), c[1].alias("second")
    )
    return rounded(rounded(out, "first", "second"), "intercept", places=1)


@query("""select period, target, entity, cast(third as int) as third, round(residual, 2) as residual from lm_resid""", "lm_resid")
def residuals_multi(spark, sf):
    return rounded(_two(spark, sf).residuals.select("period", "target", "entity", "third", "residual"), "residual", places=2)


@query("""select period, target, round(rmse, 2) as rmse,
  round(case when rmse / m between 0 and 1 then rmse / m else rmse / s end, 8) as nrmse, round(r2, 8) as r2
from lm_best join (select period, target, avg(y) m, max(y) - min(y) s,
  1 - sum(residual * residual) / nullif(count(*) * var_pop(y), 0) r2 from lm_resid group by 1, 2) using (period, target)""",
       "lm_best lm_resid")
def performance_multi(spark, sf):
    return rounded(rounded(multilinear.performance(_two(spark, sf)), "rmse", places=2), "nrmse", "r2", places=8)


@query("""select period, target, predictor, round(case when rn = 1 then c1 else c2 end, 6) as coefficient,
  round(abs(case when rn = 1 then b1 else b2 end), 8) as importance
from lm_model join lm_rank using (period, target) where rn <= 2""", "lm_model")
def importances_multi(spark, sf):
    return rounded(rounded(multilinear.importances(_two(spark, sf)), "coefficient"), "importance", places=8)


@query("""select r.period, r.target, r.entity, round(p, 1) as prediction, round(p + low, 1) as lower, round(p + high, 1) as upper
from (select r.*, intercept + c1 * coalesce(v1, f1) + c2 * coalesce(v2, f2) as p
      from lm_rows r join lm_fill using (period, target) join lm_model using (period, target) where r.y is null and r.in_focus) r
join (select period, target, quantile_cont(residual, 0.05) low, quantile_cont(residual, 0.95) high
      from lm_resid group by 1, 2) q using (period, target)""", "lm_model lm_resid")
def year_by_year_multi(spark, sf):
    return rounded(_two(spark, sf).predictions, "prediction", "lower", "upper", places=1)


@query()
def model_elastic_net(spark, sf):
    """Ten predictors, every penalty: predictions of all targets with their bands."""
    return multilinear.year_by_year(i.panel_l(spark, sf), i.focus_l(spark, sf)).predictions


i.SQL["rf_moments"] = """rf_moments as materialized (
  select period, target, coalesce(case when isfinite(corr(x1, x2)) then corr(x1, x2) end, 0) r12, coalesce(case when isfinite(corr(x1, x3)) then corr(x1, x3) end, 0) r13, coalesce(case when isfinite(corr(x2, x3)) then corr(x2, x3) end, 0) r23, coalesce(case when isfinite(corr(x1, y)) then corr(x1, y) end, 0) g1,
         coalesce(case when isfinite(corr(x2, y)) then corr(x2, y) end, 0) g2, coalesce(case when isfinite(corr(x3, y)) then corr(x3, y) end, 0) g3
  from lm_train group by 1, 2)"""
i.SQL["rf_first"] = """rf_first as materialized (
  select *, round(abs((g1 * (a * a - r23 * r23) - r12 * (g2 * a - r23 * g3) + r13 * (g2 * r23 - a * g3)) / det), 9) s1,
         round(abs((a * (g2 * a - r23 * g3) - g1 * (r12 * a - r23 * r13) + r13 * (r12 * g3 - g2 * r13)) / det), 9) s2,
         round(abs((a * (a * g3 - g2 * r23) - r12 * (r12 * g3 - g2 * r13) + g1 * (r12 * r23 - a * r13)) / det), 9) s3
  from (select *, a * (a * a - r23 * r23) - r12 * (r12 * a - r23 * r13) + r13 * (r12 * r23 - a * r13) det
        from (select *, 1.001::double as a from rf_moments)))"""
i.SQL["rf_left"] = """rf_left as materialized (
  select period, target, p, q, round(abs((a * gp - r * gq) / (a * a - r * r)), 9) sp, round(abs((a * gq - r * gp) / (a * a - r * r)), 9) sq
  from (select period, target, a,
          case when gone = 1 then 2 else 1 end p, case when gone = 3 then 2 else 3 end q,
          case gone when 1 then r23 when 2 then r13 else r12 end r,
          case when gone = 1 then g2 else g1 end gp, case when gone = 3 then g2 else g3 end gq
        from (select *, case when s3 <= s1 and s3 <= s2 then 3 when s2 <= s1 then 2 else 1 end gone from rf_first)))"""
i.NEEDS |= {"rf_moments": ["lm_train"], "rf_first": ["rf_moments"], "rf_left": ["rf_first"]}


def _candidates(spark, sf, k):
    """(chosen predictors, sums of products of each target's labelled rows with its ``k`` strongest ones)."""
    panel = cut(i.panel_l(spark, sf), "panel")
    chosen = cut(design.strongest_predictors(pair_stats(panel, ["period"], "entity"), k), "predictors")
    return chosen, cut(gram.products(design.design(panel, chosen, k), design.TARGET, []), "sums")


def _named(chosen, selected):
    """Selected positions as predictors; a position beyond a target's predictors has none."""
    names = chosen.select(*design.TARGET, (F.col("rank") - 1).alias("position"), "predictor")
    return selected.join(names, [*design.TARGET, "position"]).select(*design.TARGET, "predictor", "rank", "score")


@query("""select l.period, l.target, k.predictor, cast(l.rank as int) as rank, round(l.score, 6) as score
from (select period, target, p as at, case when sp >= sq then 1 else 2 end as rank, sp as score from rf_left
      union all select period, target, q, case when sp >= sq then 2 else 1 end, sq from rf_left) l
join lm_rank k on k.period = l.period and k.target = l.target and k.rn = l.at""", "rf_left")
def rfe_select(spark, sf):
    """Of three candidates two stay."""
    chosen, sums = _candidates(spark, sf, 3)
    return rounded(_named(chosen, gram.eliminated(sums, design.TARGET, 2, 1)), "score")


@query()
def rfe_select_wide(spark, sf):
    """Of thirty candidates ten stay, ten going a round."""
    chosen, sums = _candidates(spark, sf, 30)
    return _named(chosen, gram.eliminated(sums, design.TARGET, 10, 10))


@query()
def pca_select(spark, sf):
    """Of thirty candidates the ten that lead the first ten components, or load most on them."""
    chosen, sums = _candidates(spark, sf, 30)
    loaded = cut(gram.loadings(sums, design.TARGET, 10), "loadings")
    return _named(chosen, gram.strongest_loadings(loaded, design.TARGET, 10))


def _tubed(spark, sf, **settings):
    """Support vector regression of every target on its ten strongest predictors, in standard units."""
    panel = cut(i.panel_l(spark, sf), "panel")
    chosen = design.strongest_predictors(pair_stats(panel, ["period"], "entity"), 10)
    return svr.fit(design.design(panel, cut(chosen, "predictors"), 10), design.TARGET, **settings)


@query()
def model_svr_linear(spark, sf):
    return _tubed(spark, sf, epsilon=0.1, steps=15)


@query()
def model_svr_nu(spark, sf):
    return _tubed(spark, sf, nu=0.5, steps=15)
