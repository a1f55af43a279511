"""Wide tables to the long panel and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions import null_if_nan
from panelweave.operators.ranking import parts_of

def unpivot(
    wide: DataFrame, ids: Sequence[str], periods: Sequence[str], keep_nulls: bool = False
) -> DataFrame:
    """One row per (ids, period); null cells are dropped unless kept."""
    long = wide.unpivot(list(ids), list(periods), "period", "value").select(
        *ids, F.col("period").cast("int").alias("period"), null_if_nan("value").alias("value")
    )
    return long if keep_nulls else long.where("value is not null")


def column_labels(df: DataFrame, column: str) -> list[str]:
    """Sorted labels that become columns; columns are schema, which the driver holds.

    Where there are too many for a schema, keep the long form.
    """
    return sorted(str(r[0]) for r in df.select(column).distinct().collect())


def pivot_panel(
    panel: DataFrame,
    keys: Sequence[str] = ("entity", "period"),
    columns: Sequence[str] | None = None,
    label: str = "indicator",
    value: str = "value",
    part: int = 1 << 18,
) -> DataFrame:
    """One column per label, one row per key.

    Cells are dealt by key over parts of about ``part`` cells, so a task's rows do not grow with
    the panel. ``panel`` is read for its size and for its labels first: write it, if it is costly.
    """
    columns = column_labels(panel, label) if columns is None else list(columns)
    dealt = panel.repartition(parts_of(panel, part), *keys)
    return dealt.groupBy(*keys).pivot(label, columns).agg(F.first(value))


def densify(
    panel: DataFrame, entities: DataFrame, labels: DataFrame, label_cols: Sequence[str],
    block: int = 1024, group: int = 4096,
) -> DataFrame:
    """Every (entity, label) cell, with a null value where nothing is observed.

    The result is the product of entities and labels, as that is what is asked
    for. ``labels`` are packed into lists of about ``block`` entries; entities are
    dealt into groups of about ``group``, and each list goes once to each group, so
    the join has lists times groups keys, none of them hot.
    """
    groups = F.greatest(entities.select(F.ceil(F.count("*") / group)).scalar(), F.lit(1))
    blocks = labels.select(F.ceil(F.count("*") / block)).scalar()
    packed = (
        labels.select(*label_cols)
        .withColumn("block", F.pmod(F.xxhash64(*label_cols), F.greatest(blocks, F.lit(1))))
        .groupBy("block")
        .agg(F.collect_list(F.struct(*label_cols)).alias("list"))
        .withColumn("group", F.explode(F.sequence(F.lit(0), groups - 1).cast("array<bigint>")))
    )
    spread = entities.select("entity").withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1).cast("array<bigint>")),
        "group": F.pmod(F.xxhash64("entity"), groups),
    })
    cells = spread.join(packed, ["block", "group"]).select("entity", F.inline("list"))
    keys = ["entity", *label_cols]
    return cells.join(panel.select(*keys, "value"), keys, "left")
