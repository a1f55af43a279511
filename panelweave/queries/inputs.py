"""Panels derived from the given tables, each as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators.ranking import quantiles
from panelweave.operators.reshape import densify

SQL = {
    "panel_l": """panel_l as (
  select l_suppkey entity, p_brand || '-' || l_returnflag indicator,
         cast(year(l_shipdate) as int) period,
         cast(sum(cast(round(l_extendedprice * 100) as bigint)) as double) as value
  from lineitem join part on l_partkey = p_partkey group by 1, 2, 3)""",
    "days": """days as (
  select cast(unnest(generate_series(min(period), max(period))) as int) as p from panel_e)""",
    "panel_e": """panel_e as (
  select user_id entity, event_type || '-' || case when hour(ts) < 12 then 'am' else 'pm' end indicator,
         cast(day(ts) as int) period,
         cast(sum(cast(round(value * 100) as bigint)) as double) as value
  from events group by 1, 2, 3)""",
    "focus_l": """focus_l as (
  select s_suppkey entity from supplier join nation on s_nationkey = n_nationkey where n_regionkey = 0)""",
    "focus_e": """focus_e as (
  select c_custkey entity from customer join nation on c_nationkey = n_nationkey
  where n_regionkey = 0 and c_custkey in (select user_id from events))""",
    "dim_l": """dim_l as (
  select distinct indicator, regexp_replace(indicator, '-[^-]*$', '') dataset,
         regexp_extract(indicator, '[^-]*$', 0) category,
         case when indicator not like '%-N' then 'Revenue of ' || indicator end as name
  from panel_l)""",
    "pairs_l": "pairs_l as (select distinct indicator, period from panel_l)",
    "dense_l": """dense_l as (
  select f.entity, q.indicator, q.period, p.value
  from focus_l f cross join pairs_l q
  left join panel_l p on p.entity = f.entity and p.indicator = q.indicator and p.period = q.period)""",
    "pred_given": """pred_given as (
  select d.entity, d.indicator, d.period, s.prediction, s.lower, s.upper
  from dense_l d join (
    select indicator, period, round(avg(value), 6) prediction,
           round(quantile_cont(value, 0.05), 6) as lower, round(quantile_cont(value, 0.95), 6) as upper
    from panel_l group by 1, 2) s on d.indicator = s.indicator and d.period = s.period
  where d.value is null)""",
    "importance_given": """importance_given as (
  select t.period, t.indicator target, p.indicator feature,
         cast(p.n as double) / (sum(p.n) over (partition by t.period, t.indicator)) as value
  from (select period, indicator, count(*) n from panel_l group by 1, 2) t
  join (select period, indicator, count(*) n from panel_l group by 1, 2) p
    on t.period = p.period and t.indicator <> p.indicator)""",
    "filled_e": """filled_e as (
  select entity, indicator, cast(g.p as int) period,
         case when g.p > s.period and s.nxt is not null
              then s.value + (s.nxt_value - s.value) / (s.nxt - s.period) * (g.p - s.period)
              else s.value end as value
  from (select *, lag(period) over w prv, lead(period) over w nxt, lead(value) over w nxt_value
        from panel_e window w as (partition by entity, indicator order by period)) s,
       days g
  where (g.p >= s.period or s.prv is null) and (g.p < s.nxt or s.nxt is null))""",
}
NEEDS = {
    "dim_l": ["panel_l"],
    "pairs_l": ["panel_l"],
    "dense_l": ["panel_l", "focus_l", "pairs_l"],
    "pred_given": ["dense_l"],
    "importance_given": ["panel_l"],
    "filled_e": ["panel_e", "days"],
    "days": ["panel_e"],
}


def with_inputs(names: str, body: str) -> str:
    """``body`` behind the definitions it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "with " + ",\n".join(SQL[n] for n in order) + "\n" + body


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def in_cents(amount: str):
    """Whole cents: sums and means of them are exact whatever the order of addition."""
    return F.sum(F.round(F.col(amount) * 100).cast("long")).cast("double")


def panel_l(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per supplier, brand and return flag, and ship year."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (
        table(spark, sf, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("l_suppkey").alias("entity"),
            F.concat("p_brand", F.lit("-"), "l_returnflag").alias("indicator"),
            F.year("l_shipdate").alias("period"),
        )
        .agg(in_cents("l_extendedprice").alias("value"))
    )


def panel_e(spark: SparkSession, sf: str) -> DataFrame:
    """Event value per user, event type and half day, and day."""
    half = F.when(F.hour("ts") < 12, "am").otherwise("pm")
    return (
        table(spark, sf, "events")
        .groupBy(
            F.col("user_id").alias("entity"),
            F.concat("event_type", F.lit("-"), half).alias("indicator"),
            F.day("ts").alias("period"),
        )
        .agg(in_cents("value").alias("value"))
    )


def _first_region(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").where("n_regionkey = 0").select("n_nationkey")


def focus_l(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of the first region."""
    nations = _first_region(spark, sf)
    supplier = table(spark, sf, "supplier")
    return supplier.join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi"
    ).select(F.col("s_suppkey").alias("entity"))


def focus_e(spark: SparkSession, sf: str) -> DataFrame:
    """Users that are customers of the first region."""
    nations = _first_region(spark, sf)
    customers = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    users = table(spark, sf, "events").select("user_id").distinct()
    return customers.join(users, F.col("c_custkey") == F.col("user_id"), "left_semi").select(
        F.col("c_custkey").alias("entity")
    )


def dim_of(panel: DataFrame) -> DataFrame:
    """Indicator dimension: dataset, category and, for most, a name."""
    named = ~F.col("indicator").like("%-N")
    return panel.select("indicator").distinct().select(
        "indicator",
        F.regexp_replace("indicator", "-[^-]*$", "").alias("dataset"),
        F.regexp_extract("indicator", "[^-]*$", 0).alias("category"),
        F.when(named, F.concat(F.lit("Revenue of "), "indicator")).alias("name"),
    )


def dense_l(panel: DataFrame, focus: DataFrame) -> DataFrame:
    """Every focus cell of the (indicator, period) columns."""
    pairs = panel.select("indicator", "period").distinct()
    return densify(panel, focus, pairs, ["indicator", "period"])


def pred_given(panel: DataFrame, focus: DataFrame) -> DataFrame:
    """A prediction table without a model: column mean and 5 % / 95 % quantiles."""
    keys = ["indicator", "period"]
    means = panel.groupBy(*keys).agg(F.round(F.avg("value"), 6).alias("prediction"))
    band = quantiles(panel, keys, "value", {"lower": 0.05, "upper": 0.95})
    stats = means.join(
        band.select(*keys, F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper")), keys
    )
    return dense_l(panel, focus).where("value is null").drop("value").join(stats, keys)


def importance_given(panel: DataFrame) -> DataFrame:
    """Each predictor's share of the rows of all predictors of a target."""
    n = panel.groupBy("period", "indicator").agg(F.count("*").alias("n"))
    total = n.groupBy("period").agg(F.sum("n").alias("total"))
    targets = n.join(total, "period").select(
        "period", F.col("indicator").alias("target"), (F.col("total") - F.col("n")).alias("others")
    )
    features = n.select("period", F.col("indicator").alias("feature"), "n")
    return (
        targets.join(features, "period")
        .where("target <> feature")
        .select("period", "target", "feature", (F.col("n") / F.col("others")).alias("value"))
    )
