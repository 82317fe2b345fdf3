"""Row numbers within large groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)


def spread_row_number(
    df: DataFrame, group: str, measure: str, tie_key: str, out: str, digits: int = 3
) -> DataFrame:
    """``row_number() over (partition by group order by measure desc, tie_key)`` for big groups.

    ``tie_key`` must be an evenly spread lowercase hex text, such as an MD5 surrogate key. Its
    first ``digits`` characters cut every (group, measure) level into at most ``16**digits`` slots.
    Rows are counted per slot, the counts are accumulated into each slot's starting rank, and the
    only window over the rows themselves is partitioned by slot. So neither one huge group nor one
    huge run of equal measures ends up in a single task, and the numbering is exact.

    The windows over counts see one row per distinct measure of a group (at most about the square
    root of twice the group's total) or one row per slot of a level.

    ``df`` is read twice; save it first when it is costly.
    """
    # A null group is a group too, so levels and slots are matched on text that is never null.
    level = F.concat_ws(
        "/", F.coalesce(F.col(group).cast("string"), F.lit("null")), F.col(measure).cast("string")
    )
    keyed = df.withColumn("_level", level).withColumn(
        "_slot", F.concat_ws("/", "_level", F.substring(tie_key, 1, digits))
    )
    slots = keyed.groupBy(group, measure, "_level", "_slot").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    by_level = Window.partitionBy(group).orderBy(F.desc(measure)).rowsBetween(*BEFORE)
    levels = (
        slots.groupBy(group, measure, "_level")
        .agg(F.sum("_rows").alias("_rows"))
        .select("_level", F.coalesce(F.sum("_rows").over(by_level), F.lit(0)).alias("_above"))
    )
    in_level = Window.partitionBy("_level").orderBy("_slot").rowsBetween(*BEFORE)
    starts = (
        slots.withColumn("_in_level", F.coalesce(F.sum("_rows").over(in_level), F.lit(0)))
        .join(levels, "_level")
        .select("_slot", (F.col("_above") + F.col("_in_level")).alias("_start"))
    )
    in_slot = Window.partitionBy("_slot").orderBy(tie_key)
    return (
        keyed.join(starts, "_slot")
        .withColumn(out, F.col("_start") + F.row_number().over(in_slot))
        .drop("_level", "_slot", "_start")
    )
