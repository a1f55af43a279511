"""Profiles, imputation, merging, series, ranking and error measures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelweave.operators import documents as docs
from panelweave.operators import merge, neighbours, pairs, profile, ranking, rows, scaling, scores, series
from panelweave.queries import inputs as i
from panelweave.queries.registry import query
from panelweave.session import cut

# Targets of the sparse panel come 15 periods after its first, so that every
# target has the full 13 windows of a 15-period slice with lag 3.
BACK, SHARE = 15, 0.85


def extent(panel):
    """First and last period of a panel."""
    return tuple(panel.agg(F.min("period"), F.max("period")).first())


def span(panel):
    """(first target period, end) of a panel, and its first period by name."""
    first, last = extent(panel)
    return (first + BACK, last + 1), {"first": first}


def rounded(df, *columns, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in columns})


i.SQL["mom"] = """mom as (
  select indicator, avg(value) m, sum(value * value) - count(*) * avg(value) * avg(value) q
  from panel_l group by 1)"""

i.SQL["near"] = """near as (
  select e.*, g.p, row_number() over (partition by entity, indicator, g.p order by abs(period - g.p), period) rn
  from panel_e e cross join days g)"""

# --- missingness and validity -------------------------------------------------

i.SQL["miss"] = """miss as (
  select period, indicator, n - count(value) as absolute_missing,
         (n - count(value)) * cast(100 as double) / n as percent_missing
  from panel_l, (select count(distinct entity) n from panel_l) group by period, indicator, n)"""


@query("""select *, row_number() over (partition by period order by percent_missing, indicator) as position
from miss""", "panel_l miss")
def missingness(spark, sf):
    rank = F.row_number().over(Window.partitionBy("period").orderBy("percent_missing", "indicator"))
    return profile.missingness(i.panel_l(spark, sf)).withColumn("position", rank)


@query("""select entity, indicator, n - count(value) as absolute_missing, count(value) as total,
  (n - count(value)) * cast(100 as double) / n as percent_missing
from panel_l, (select count(distinct period) n from panel_l) group by entity, indicator, n""", "panel_l")
def pair_missingness(spark, sf):
    return profile.pair_missingness(i.panel_l(spark, sf))


@query("""select period, indicator, n - count(p.value) as absolute_missing,
  (n - count(p.value)) * cast(100 as double) / n as percent_missing
from panel_l p, (select count(*) n from focus_l) where p.entity in (select entity from focus_l)
group by period, indicator, n
having (n - count(p.value)) * 100.0 / n < 90 and (n - count(p.value)) > 0""", "panel_l focus_l")
def rank_focus(spark, sf):
    focus = i.focus_l(spark, sf)
    panel = rows.in_focus(i.panel_l(spark, sf), focus)
    return profile.rank_indicators(profile.missingness(panel, focus), 90)


@query("select * from miss where percent_missing > 0 and percent_missing < 40", "panel_l miss")
def rank_total(spark, sf):
    return profile.rank_indicators(profile.missingness(i.panel_l(spark, sf)), 40)


@query("""select indicator, (select count(*) from focus_e) - count(distinct f.entity) as missing_focus
from panel_e p left join focus_e f on p.entity = f.entity
group by 1""", "panel_e focus_e")
def missing_focus(spark, sf):
    return profile.missing_focus(i.panel_e(spark, sf), i.focus_e(spark, sf))


i.SQL["focused_e"] = """focused_e as (select * from panel_e where entity in (select entity from focus_e))"""
i.SQL["profile_e"] = """profile_e as (
  select t.p as period, indicator, count(*) slice_size,
         cast(count(*) filter (share > 0.85) as int) missing_years_count,
         string_agg(y, ',' order by y) filter (share > 0) missing_years,
         string_agg(y, ',' order by y) filter (share = 0) available_years,
         string_agg(y, ',' order by y) filter (share < 1) target_years,
         max(case when y = t.p and share > 0 then 1 else 0 end) as now_missing
  from (select p from days where p >= (select min(p) from days) + 15) t(p)
  join (select b.indicator, g.y, (b.base - coalesce(c.seen, 0)) / cast(b.base as double) share
        from (select indicator, count(distinct entity) base from focused_e group by 1) b
        cross join days g(y)
        left join (select indicator, period, count(*) seen from focused_e group by 1, 2) c
          on c.indicator = b.indicator and c.period = g.y) s
    on s.y between greatest((select min(p) from days), t.p - 15) and t.p
  group by 1, 2)"""
i.SQL["unseen_e"] = """unseen_e as (
  select indicator, (select count(*) from focus_e) - count(distinct entity) as missing_focus
  from focused_e group by 1)"""
i.NEEDS |= {"focused_e": ["panel_e", "focus_e"], "profile_e": ["focused_e", "days"], "near": ["panel_e", "days"], "unseen_e": ["focused_e"]}


def _focused_e(spark, sf):
    return rows.in_focus(i.panel_e(spark, sf), i.focus_e(spark, sf))


def _joined(df, *columns):
    """Lists as text, so that both engines show them alike."""
    return df.withColumns({c: F.nullif(F.array_join(c, ","), F.lit("")) for c in columns})


_LISTS = ("missing_years", "available_years", "target_years")


@query("""select cast(period as int) as period, indicator, missing_years_count, missing_years, available_years, target_years from profile_e""", "profile_e")
def missing_year_profile(spark, sf):
    targets, first = span(i.panel_e(spark, sf))
    out = profile.missing_year_profile(_focused_e(spark, sf), *targets, limit=SHARE, **first)
    return _joined(out, *_LISTS).drop("slice_size")


@query("""select cast(period as int) as period, indicator, missing_years_count, missing_years, available_years, target_years,
  missing_focus, now_missing = 1 or missing_focus > 0 as target_validity
from profile_e join unseen_e using (indicator)
where missing_focus < 15 and missing_years_count < slice_size / 2.0""", "profile_e unseen_e")
def validity_check(spark, sf):
    targets, first = span(i.panel_e(spark, sf))
    out = profile.validity_check(
        _focused_e(spark, sf), i.focus_e(spark, sf), *targets, 15, 2, limit=SHARE, **first
    )
    return _joined(out, *_LISTS)


@query("""select cast(period as int) as period, indicator from profile_e join unseen_e using (indicator)
where missing_focus < 15 and missing_years_count < slice_size / 2.0""", "profile_e unseen_e")
def predictor_validity(spark, sf):
    targets, first = span(i.panel_e(spark, sf))
    return profile.predictor_validity(
        _focused_e(spark, sf), i.focus_e(spark, sf), *targets, limit=SHARE, **first
    )


@query("""select cast(period as int) as period, indicator from profile_e join unseen_e using (indicator)
where missing_focus < 50 and missing_years_count < slice_size / 1.25
  and (now_missing = 1 or missing_focus > 0)""", "profile_e unseen_e")
def target_validity(spark, sf):
    targets, first = span(i.panel_e(spark, sf))
    return profile.target_validity(
        _focused_e(spark, sf), i.focus_e(spark, sf), *targets, limit=SHARE, **first
    )


@query("""select d.dataset, period, count(*) filter (where value is null) as missing_cells,
  count(*) = count(value) as complete
from dense_l join dim_l d using (indicator) group by 1, 2""", "dense_l dim_l")
def missing_audit(spark, sf):
    panel = i.panel_l(spark, sf)
    return profile.missing_audit(panel, i.dim_of(panel), i.focus_l(spark, sf))


@query("""select t.period, t.indicator as target, d.n as n_train, coalesce(k.k, 0) as predictors,
  coalesce(r.r, 0) as to_predict,
  case when d.n < 5 then 'too few rows' when coalesce(k.k, 0) = 0 then 'no predictor'
       when coalesce(r.r, 0) = 0 then 'nothing to predict' end as reason
from targets t
join joint d on d.period = t.period and d.target = t.indicator and d.predictor = t.indicator
left join (select period, target, count(*) k from predictors group by 1, 2) k
  on k.period = t.period and k.target = t.indicator
left join (select period, indicator, count(*) r from dense_l where value is null group by 1, 2) r
  on r.period = t.period and r.indicator = t.indicator""", "targets dense_l predictors")
def eligibility(spark, sf):
    from panelweave.plans.frames import eligibility as checked

    panel = i.panel_l(spark, sf)
    return checked(panel, i.focus_l(spark, sf), target_percent=90, predictor_percent=40, folds=5)


# --- imputation and scaling -----------------------------------------------------


@query("""select d.entity, d.indicator, d.period, coalesce(d.value, m.mean) as value
from dense_l d join (select indicator, period, avg(value) mean from panel_l group by 1, 2) m
  using (indicator, period)""", "dense_l")
def mean_impute(spark, sf):
    panel = i.panel_l(spark, sf)
    cells = i.dense_l(panel, i.focus_l(spark, sf))
    return scaling.mean_impute(cells, panel, ["indicator", "period"])


i.SQL["scaled_l"] = """scaled_l as (
  select entity, indicator, period, (value - lo) / case when hi = lo then 1.0 else hi - lo end as value
  from panel_l join (select indicator, period, min(value) lo, max(value) hi from panel_l group by 1, 2)
    using (indicator, period))"""


@query("select entity, indicator, period, round(value, 9) as value from scaled_l", "panel_l scaled_l")
def minmax_scale(spark, sf):
    panel = i.panel_l(spark, sf)
    stats = scaling.feature_stats(panel, ["indicator", "period"])
    return rounded(scaling.minmax_scale(panel, stats, ["indicator", "period"]), "value", places=9)


@query("select entity, indicator, period, value from panel_l", "panel_l")
def minmax_inverse(spark, sf):
    panel, keys = i.panel_l(spark, sf), ["indicator", "period"]
    stats = scaling.feature_stats(panel, keys)
    back = scaling.minmax_inverse(scaling.minmax_scale(panel, stats, keys), stats, keys)
    return rounded(back, "value", places=4)


@query("""select period, indicator as target, entity, in_focus,
  1.0 / count(*) over (partition by period, indicator, in_focus) as weight
from (select *, entity in (select entity from focus_l) as in_focus from panel_l)""", "panel_l focus_l")
def class_weights(spark, sf):
    train = rows.mark_focus(i.panel_l(spark, sf), i.focus_l(spark, sf)).select(
        "period", F.col("indicator").alias("target"), "entity", "in_focus"
    )
    return scaling.class_weights(train, ["period", "target"])


@query("""select period, entity, indicator, round(value, 4) as value, is_imputed from (
  select period, entity, indicator, value, false as is_imputed from panel_l
  union all
  select m.period, m.entity, m.indicator,
         coalesce(avg(c.donor_value) filter (c.rn <= 5), any_value(m.mean)), true
  from (select e.entity, q.indicator, q.period, q.mean
        from (select distinct entity from panel_l) e
        cross join (select indicator, period, avg(value) mean from panel_l group by 1, 2) q
        where not exists (select 1 from panel_l p where p.entity = e.entity
                          and p.indicator = q.indicator and p.period = q.period)) m
  left join (
    select g.*, p.value donor_value, p.indicator,
           row_number() over (partition by g.period, g.receiver, p.indicator order by g.d, g.donor) rn
    from (select a.period, a.entity receiver, b.entity donor,
                 round(sum((a.value - b.value) * (a.value - b.value)) / count(*), 9) d
          from scaled_l a join scaled_l b on a.period = b.period and a.indicator = b.indicator
          group by 1, 2, 3) g
    join panel_l p on p.period = g.period and p.entity = g.donor
    where not exists (select 1 from panel_l o where o.period = g.period and o.entity = g.receiver
                      and o.indicator = p.indicator)) c
    on c.period = m.period and c.receiver = m.entity and c.indicator = m.indicator
  group by m.period, m.entity, m.indicator)""", "panel_l scaled_l")
def knn_impute(spark, sf):
    panel = cut(i.panel_l(spark, sf), "panel")
    entities = panel.select("entity").distinct()
    periods = panel.select("period").distinct()
    grid = _entity_periods(entities, periods)
    out = neighbours.knn_impute(grid, panel, panel, ["period"])
    return rounded(out, "value", places=4)


def _entity_periods(entities, periods):
    from panelweave.operators.reshape import densify

    none = entities.limit(0).select("entity", F.lit(0).alias("period"), F.lit(0.0).alias("value"))
    return densify(none, entities, periods, ["period"]).select("entity", "period")


@query("""select target, predictor, round(strength, 6) as strength, cast(rn as int) as rank from (
  select *, row_number() over (partition by target order by round(strength, 9) desc, predictor) rn from (
    select a.indicator target, b.indicator predictor,
           coalesce(abs(sum((a.value - ma.m) * (b.value - mb.m)) / nullif(sqrt(ma.q * mb.q), 0)), 0) strength
    from panel_l a join panel_l b on a.entity = b.entity and a.period = b.period and a.indicator <> b.indicator
    join mom ma on ma.indicator = a.indicator join mom mb on mb.indicator = b.indicator
    group by a.indicator, b.indicator, ma.q, mb.q))
where rn <= 10""", "panel_l mom")
def nearest_features(spark, sf):
    cells = i.panel_l(spark, sf).select(
        F.struct("entity", "period").alias("row"), "indicator", "value"
    )
    cells = cells.withColumn("row", F.concat_ws("|", "row.entity", "row.period"))
    return rounded(pairs.nearest_features(pairs.pair_stats(cells, [], "row"), []), "strength")



# --- merging --------------------------------------------------------------------

i.SQL["filled_l"] = """filled_l as (
  select entity, indicator, period, coalesce(d.value, p.prediction) as value,
         case when d.value is null then p.lower end as lower,
         case when d.value is null then p.upper end as upper, d.value is null as is_imputed
  from dense_l d left join pred_given p using (entity, indicator, period)
  where (indicator, period) in (select indicator, period from pred_given))"""
i.NEEDS["filled_l"] = ["pred_given"]


def _filled(spark, sf):
    panel, focus = i.panel_l(spark, sf), i.focus_l(spark, sf)
    return merge.fill_cells(panel, i.pred_given(panel, focus), focus)


@query("select * from filled_l", "filled_l")
def fill_cells(spark, sf):
    return _filled(spark, sf)


@query("""select * from filled_l where period < 2001
union all select entity, indicator, period, prediction, lower, upper, true from pred_given where period = 2001""",
       "filled_l")
def append_unmatched(spark, sf):
    panel, focus = i.panel_l(spark, sf), i.focus_l(spark, sf)
    given = i.pred_given(panel, focus)
    early = merge.fill_cells(panel, given, focus).where("period < 2001")
    return merge.append_unmatched(early, given)


@query("select entity, indicator, period, value, lower, upper from filled_l", "filled_l")
def interval_alignment(spark, sf):
    filled = _filled(spark, sf)
    cell = ["entity", "indicator", "period"]
    value, lower, upper = (
        filled.select(*cell, F.col(c).alias("value")) for c in ("value", "lower", "upper")
    )
    return merge.interval_alignment(value, lower, upper)


@query("""select period, target, category, round(sum(value), 9) as value
from importance_given join (select distinct indicator, category from dim_l) on feature = indicator
group by 1, 2, 3""", "importance_given dim_l")
def category_importance(spark, sf):
    panel = i.panel_l(spark, sf)
    out = merge.category_importance(i.importance_given(panel), i.dim_of(panel), ["period", "target"])
    return rounded(out, "value", places=9)


@query("""select period, target, feature, round(sum(value / l.k), 9) as value
from importance_given cross join generate_series(1, 3) l(k) group by 1, 2, 3""", "importance_given")
def lag_importance(spark, sf):
    lagged = i.importance_given(i.panel_l(spark, sf)).withColumn(
        "lag", F.explode(F.sequence(F.lit(1), F.lit(3)))
    ).select(
        "period", "target", F.concat("feature", F.lit("#"), F.col("lag").cast("string")).alias("feature"),
        (F.col("value") / F.col("lag")).alias("value"),
    )
    return rounded(merge.lag_importance(lagged, ["period", "target"]), "value", places=9)


@query("""select * from (select period, target, feature, round(value, 9) as value,
  cast(row_number() over (partition by period, target order by value desc, feature) as int) as rank
  from importance_given) where rank <= 10""", "importance_given")
def topk_importance(spark, sf):
    importance = i.importance_given(i.panel_l(spark, sf))
    top = ranking.top_k(importance, ["period", "target"], [F.desc("value"), "feature"], 10)
    return rounded(top, "value", places=9)


# --- series ---------------------------------------------------------------------


@query("select entity, indicator, period, value from filled_e", "filled_e")
def interpolate_linear(spark, sf):
    panel = i.panel_e(spark, sf)
    return series.interpolate_linear(panel, *extent(panel))


@query("""select s.entity, s.indicator, cast(g.p as int) as period, round(
  n1.value * (g.p - n2.period) / (n1.period - n2.period) * (g.p - n3.period) / (n1.period - n3.period)
  + n2.value * (g.p - n1.period) / (n2.period - n1.period) * (g.p - n3.period) / (n2.period - n3.period)
  + n3.value * (g.p - n1.period) / (n3.period - n1.period) * (g.p - n2.period) / (n3.period - n2.period), 6) as value
from (select entity, indicator, min(period) lo, max(period) hi from panel_e group by 1, 2) s
join days g on g.p between s.lo and s.hi
join near n1 on n1.entity = s.entity and n1.indicator = s.indicator and n1.p = g.p and n1.rn = 1
join near n2 on n2.entity = s.entity and n2.indicator = s.indicator and n2.p = g.p and n2.rn = 2
join near n3 on n3.entity = s.entity and n3.indicator = s.indicator and n3.p = g.p and n3.rn = 3
where not exists (select 1 from panel_e o where o.entity = s.entity and o.indicator = s.indicator and o.period = g.p)
union all select entity, indicator, period, value from panel_e""", "near")
def interpolate_poly(spark, sf):
    panel = i.panel_e(spark, sf)
    return rounded(series.interpolate_poly(panel, *extent(panel), 2), "value")


i.SQL["lags_e"] = """lags_e as (
  select entity, indicator, cast(period + l.k as int) as win, cast(l.k as int) as lag, value
  from filled_e cross join generate_series(1, 3) l(k))"""
i.NEEDS["lags_e"] = ["filled_e"]


@query('select entity, indicator, win as "window", lag, value from lags_e', "lags_e")
def lag_features(spark, sf):
    panel = i.panel_e(spark, sf)
    return series.lag_features(series.interpolate_linear(panel, *extent(panel)), 3)


i.SQL["windows_e"] = """windows_e as (
  select t.period, t.indicator, cast(w.w as int) as win, cast(1 as double) / (1 + t.period - w.w) as weight
  from (select distinct period, indicator from panel_e where period >= (select min(p) from days) + 15) t
  join days w(w) on w.w between greatest((select min(p) from days), t.period - 15) + 3 and t.period)"""
i.NEEDS["windows_e"] = ["panel_e", "days"]


def _targets_e(panel):
    targets, _ = span(panel)
    return rows.period_range(panel, *targets).select("period", "indicator").distinct()


def _windows_e(panel):
    return series.training_windows(_targets_e(panel), **span(panel)[1]).withColumnRenamed("indicator", "target")


@query("""select w.period, w.indicator, w.win as "window", p.entity, p.value
from windows_e w join panel_e p on p.indicator = w.indicator and p.period = w.win""", "windows_e")
def training_windows(spark, sf):
    panel = i.panel_e(spark, sf)
    windows = series.training_windows(_targets_e(panel), **span(panel)[1]).drop("weight")
    labels = panel.withColumnRenamed("period", "window")
    return windows.join(labels, ["indicator", "window"])


@query("""select period, indicator, win as "window", weight from windows_e""", "windows_e")
def recency_weights(spark, sf):
    panel = i.panel_e(spark, sf)
    return series.training_windows(_targets_e(panel), **span(panel)[1])


@query("""select f.entity, f.win as "window", f.n_features, f.low, f.high, w.period, w.indicator as target, p.value as y, w.weight
from (select entity, win, count(*) n_features, min(value) low, max(value) high from lags_e group by 1, 2) f
join windows_e w on w.win = f.win
left join panel_e p on p.entity = f.entity and p.period = f.win and p.indicator = w.indicator""",
       "lags_e windows_e")
def ts_training_frame(spark, sf):
    panel = i.panel_e(spark, sf)
    filled = series.interpolate_linear(panel, *extent(panel))
    features = series.lag_features(filled).groupBy("entity", "window").agg(
        F.count("*").alias("n_features"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    return series.labelled_windows(features, _windows_e(panel), panel)


@query("""select w.period, w.indicator as target, f.entity from windows_e w cross join (select distinct entity from panel_e) f
left join panel_e p on p.entity = f.entity and p.period = w.win and p.indicator = w.indicator
where w.win = w.period and p.value is null""", "windows_e")
def window_split(spark, sf):
    """Cells to predict of the time-series form: the target period's window alone."""
    panel = i.panel_e(spark, sf)
    spine = panel.select("entity").distinct().withColumn(
        "window", F.explode(F.sequence(*(F.lit(p) for p in extent(panel))))
    )
    framed = series.labelled_windows(spine, _windows_e(panel), panel)
    return rows.window_split(framed)[1].select("period", "target", "entity")


# --- folds, quantiles, errors -----------------------------------------------------


@query("""select period, indicator as target, entity,
  cast(ntile(5) over (partition by period, indicator order by entity) - 1 as int) as fold from panel_l""",
       "panel_l")
def kfold(spark, sf):
    train = i.panel_l(spark, sf).select("period", F.col("indicator").alias("target"), "entity")
    return ranking.kfold(train, ["period", "target"], ["entity"], 5)


@query("""select indicator, period, round(quantile_cont(value, 0.05), 4) as lower,
  round(quantile_cont(value, 0.95), 4) as upper from panel_l group by 1, 2""", "panel_l")
def quantile_band(spark, sf):
    band = ranking.quantiles(i.panel_l(spark, sf), ["indicator", "period"], "value", {"lower": 0.05, "upper": 0.95})
    return rounded(band, "lower", "upper", places=4)


i.SQL["scored_l"] = """scored_l as (
  select p.period, p.indicator as target, p.entity, p.value as y, m.prediction,
         ntile(5) over (partition by p.period, p.indicator order by p.entity) as fold
  from panel_l p join (select indicator, period, round(avg(value), 6) prediction from panel_l group by 1, 2) m
    using (indicator, period))"""
i.SQL["rmse_l"] = """rmse_l as (
  select period, target, sqrt(avg(mse)) rmse from (
    select period, target, fold, avg((y - prediction) * (y - prediction)) mse from scored_l group by 1, 2, 3)
  group by 1, 2)"""


def _scored(spark, sf):
    panel = i.panel_l(spark, sf)
    means = panel.groupBy("indicator", "period").agg(F.round(F.avg("value"), 6).alias("prediction"))
    train = panel.join(means, ["indicator", "period"]).select(
        "period", F.col("indicator").alias("target"), "entity", F.col("value").alias("y"), "prediction"
    )
    return ranking.kfold(train, ["period", "target"], ["entity"], 5)


@query("select period, target, round(rmse, 3) as rmse from rmse_l", "panel_l scored_l rmse_l")
def rmse_folds(spark, sf):
    return rounded(scores.rmse_over_folds(_scored(spark, sf), ["period", "target"]), "rmse", places=3)


@query("""select period, target, round(rmse, 3) as rmse, round(case when rmse / m between 0 and 1 then rmse / m else rmse / s end, 9) as nrmse
from rmse_l join (select period, indicator target, avg(value) m, max(value) - min(value) s from panel_l group by 1, 2)
  using (period, target)""", "panel_l scored_l rmse_l")
def nrmse(spark, sf):
    scored, keys = _scored(spark, sf), ["period", "target"]
    out = scores.normalised_rmse(scores.rmse_over_folds(scored, keys), scores.label_stats(scored, keys), keys)
    return rounded(rounded(out, "rmse", places=3), "nrmse", places=9)


@query("""select period, target, round(quantile_cont(y - prediction, 0.05), 6) as lower,
  round(quantile_cont(y - prediction, 0.95), 6) as upper from scored_l group by 1, 2""", "panel_l scored_l")
def interval_residual_quantile(spark, sf):
    residuals = _scored(spark, sf).withColumn("residual", F.col("y") - F.col("prediction"))
    band = ranking.quantiles(residuals, ["period", "target"], "residual", {"lower": 0.05, "upper": 0.95})
    return rounded(band, "lower", "upper")


@query("""select p.indicator, p.period, count(*) as n, round(regr_slope(p.value, q.value), 6) as slope,
  round(regr_intercept(p.value, q.value), 2) as intercept
from panel_l p join panel_l q on q.entity = p.entity and q.indicator = p.indicator and q.period = p.period - 1
group by 1, 2""", "panel_l")
def linear_1d(spark, sf):
    before = F.lag("value").over(Window.partitionBy("entity", "indicator").orderBy("period"))
    prior = F.lag("period").over(Window.partitionBy("entity", "indicator").orderBy("period"))
    pairs_of = i.panel_l(spark, sf).withColumns({"x": before, "prior": prior}).where("prior = period - 1")
    return pairs_of.groupBy("indicator", "period").agg(
        F.count("*").alias("n"),
        F.round(F.regr_slope("value", "x"), 6).alias("slope"),
        F.round(F.regr_intercept("value", "x"), 2).alias("intercept"),
    )


# --- documents --------------------------------------------------------------------

i.SQL["cells_l"] = """cells_l as (
  select d.dataset, f.indicator, f.period, f.entity, f.value, f.lower, f.upper
  from filled_l f join dim_l d using (indicator))"""
i.SQL["catimp_l"] = """catimp_l as (
  select period, target, d.category, round(sum(value), 9) as value
  from importance_given join dim_l d on feature = d.indicator group by 1, 2, 3)"""
i.SQL["docs_l"] = """docs_l as (
  select dataset, indicator, 'data' as part, period, cast(entity as varchar) as key, value from cells_l
  union all select dataset, indicator, 'upperIntervals', period, cast(entity as varchar), upper from cells_l where upper is not null
  union all select dataset, indicator, 'lowerIntervals', period, cast(entity as varchar), lower from cells_l where lower is not null
  union all select d.dataset, t.target, 'featureImportances', t.period, t.feature, round(t.value, 9)
    from importance_given t join dim_l d on t.target = d.indicator
    where (t.target, t.period) in (select indicator, period from cells_l)
  union all select d.dataset, t.target, 'categoryImportances', t.period, t.category, t.value
    from catimp_l t join dim_l d on t.target = d.indicator
    where (t.target, t.period) in (select indicator, period from cells_l))"""
i.NEEDS |= {
    "cells_l": ["filled_l", "dim_l"],
    "catimp_l": ["importance_given", "dim_l"],
    "docs_l": ["cells_l", "importance_given", "catimp_l"],
}


def given_results(spark, sf):
    """(filled cells, importances, dimension) of the given predictions, with datasets."""
    panel, focus = cut(i.panel_l(spark, sf), "panel"), cut(i.focus_l(spark, sf), "focus")
    dim = cut(i.dim_of(panel), "dim")
    filled = merge.fill_cells(panel, cut(i.pred_given(panel, focus), "given"), focus)
    filled = rows.lookup(filled, dim, "indicator", "dataset")
    importance = i.importance_given(panel).withColumnRenamed("target", "indicator")
    importance = cut(rows.lookup(importance, dim, "indicator", "dataset"), "importance")
    return filled, importance, dim


def given_documents(spark, sf):
    filled, importance, dim = given_results(spark, sf)
    filled = cut(filled, "filled")
    categories = rounded(
        merge.category_importance(importance, dim, ["dataset", "indicator", "period"]), "value", places=9
    )
    out = docs.document_cells(filled, rounded(importance, "value", places=9), categories)
    return cut(out, "given-documents")


@query("select * from docs_l", "docs_l")
def doc_cells(spark, sf):
    return given_documents(spark, sf).where("key is not null")


@query("""select period, indicator, 'data' as part, cast(entity as varchar) as key, value from cells_l
union all select period, indicator, 'lowerIntervals', cast(entity as varchar), lower from cells_l where lower is not null
union all select period, indicator, 'upperIntervals', cast(entity as varchar), upper from cells_l where upper is not null""",
       "cells_l")
def entity_maps(spark, sf):
    maps = docs.entity_maps(_filled(spark, sf), ["period", "indicator"])
    parts = F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(p).alias("m"))
        for p in ("data", "lowerIntervals", "upperIntervals")
    ])).alias("p")
    return maps.select("period", "indicator", parts).select(
        "period", "indicator", "p.part", F.explode("p.m").alias("key", "value")
    )


def _shifted(rows_, by):
    return rows_.withColumn("value", F.col("value") + by)


@query("""select dataset, indicator, part, period, key, value from docs_l where period < 1998
union all select dataset, indicator, part, period, key, value + 1 from docs_l where period >= 1998""", "docs_l")
def upsert_update(spark, sf):
    given = given_documents(spark, sf)
    stored, new = given.where("period <= 1998"), _shifted(given.where("period >= 1998"), 1)
    return docs.upsert_rows(stored, new, "update").where("key is not null")


@query("""select * from docs_l where (dataset, indicator) not in (
    select (dataset, indicator) from docs_l where period >= 1998 and indicator like 'Brand#1%')
  and period <= 1998
union all select dataset, indicator, part, period, key, value + 1 from docs_l
  where period >= 1998 and indicator like 'Brand#1%'""", "docs_l")
def upsert_replace(spark, sf):
    given = given_documents(spark, sf)
    stored = given.where("period <= 1998")
    new = _shifted(given.where("period >= 1998").where(F.col("indicator").like("Brand#1%")), 1)
    return docs.upsert_rows(stored, new, "replace").where("key is not null")
