"""Exact positions and running totals inside groups of any size.

A plain window sorts each group in one task. Here the rows are range-sorted over group *and* order columns,
so a hot group is spread over many tasks, and only one small row per (partition, group) is summed up afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.runtime import materialise


def running_totals(df: DataFrame, group: list[str], order: list[str], weight: Column | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` with ``position`` (1, 2, ... inside its group) and ``before`` (sum of ``weight`` over the rows ahead of it).

    ``order`` should make rows of a group unique, else ties come in any order. Null weights count as 0, null group
    keys form a group of their own. An empty table gives an empty table. The range-sorted rows are written once to the
    shared folder, so that both the offsets and the rows see the same partition bounds. Columns of ``df`` must not be named
    position or before, or start with an underscore (ValueError).
    """
    if clash := [c for c in df.columns if c.lower() in ("position", "before") or c.startswith("_")]:
        raise ValueError(f"columns would clash: {clash}")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in (*group, *order)]
    w = F.coalesce(weight.cast("bigint"), F.lit(0)) if weight is not None else F.lit(0).cast("bigint")
    sorted_rows = df.withColumn("_w", w).repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id())
    kept = materialise(sorted_rows, "ranked")
    parts = kept.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_s"))
    ahead = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_pid").alias("_opid"),
        *[F.col(c).alias(f"_o_{c}") for c in group],
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_s0"),
    )
    local = Window.partitionBy("_pid", *group).orderBy(*order)
    here = kept.withColumn("_rn", F.row_number().over(local)).withColumn(
        "_sb", F.coalesce(F.sum("_w").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    same = F.col("_pid") == F.col("_opid")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return here.join(offsets, same).select(
        *df.columns, (F.col("_n0") + F.col("_rn")).cast("bigint").alias("position"), (F.col("_s0") + F.col("_sb")).cast("bigint").alias("before")
    )


def _alike(columns: list[str], prefix: str) -> Column:
    """Null-safe equality of columns with their prefixed copies."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])


#: Neighbouring positions that are looked at together when a median is placed.
BLOCK = 1024


def median_of_others(entries: DataFrame, group: list[str], part: str, value: str, tiebreak: list[str], block: int = BLOCK) -> DataFrame:
    """For each (group, part): the exact median of ``value`` over the rows of the group in *other* parts.

    Rows are ranked once over range-sorted partitions. Own rows are counted per block of positions, which tells in which
    block the wanted place of the others lies, and only that block is looked at: a part reads one or two blocks, however
    many rows it or its group has, and no row is paired with another. Meant for parts of many rows (years of a hot group).
    Parts without other rows are left out. Null values are ignored.
    """
    ranked = running_totals(entries.where(F.col(value).isNotNull()), group, [value, part, *tiebreak])
    ranked = materialise(ranked.select(*group, part, value, "position", ((F.col("position") - 1) / block).cast("bigint").alias("block")), "positions")
    counts = ranked.groupBy(*group, part, "block").agg(F.count(F.lit(1)).alias("c"))
    totals = counts.groupBy(*group, part).agg(F.sum("c").alias("m"))
    size = totals.groupBy(*[F.col(c).alias(f"_s_{c}") for c in group]).agg(F.sum("m").alias("n"))
    goals = totals.join(size, _alike(group, "_s_")).where("n > m").select(
        *[F.col(c).alias(f"_g_{c}") for c in (*group, part)], F.explode(F.array(F.expr("(n - m + 1) div 2"), F.expr("(n - m + 2) div 2"))).alias("k")
    ).distinct()
    # Own rows up to the end of each block that holds some; block -1 stands for the start.
    start = totals.select(*group, part, F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("c"))
    step = Window.partitionBy(*group, part).orderBy("block")
    own = counts.unionByName(start).select(*group, part, "block", F.sum("c").over(step).alias("upto"), F.lead("block").over(step).alias("next"))
    reach = F.greatest("block", F.ceil((F.col("k") + F.col("upto")) / block).cast("bigint") - 1)
    places = own.join(goals, _alike([*group, part], "_g_")).select(*group, part, "k", "block", "upto", "next", reach.alias("at")).where("next is null or at < next")
    target = places.groupBy(*group, part, "k").agg(F.min(F.struct("at", "block", "upto")).alias("t")).select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col(part).alias("_for"), "k", F.col("t.at").alias("_at")
    )
    before = own.select(*[F.col(c).alias(f"_o_{c}") for c in group], F.col(part).alias("_o_for"), F.col("block").alias("_b"), F.col("upto").alias("_u"), "next")
    known = [F.col(f"_{c}").eqNullSafe(F.col(f"_o_{c}")) for c in group] + [F.col("_for").eqNullSafe(F.col("_o_for"))]
    ahead = (F.col("_b") < F.col("_at")) & (F.col("next").isNull() | (F.col("next") >= F.col("_at")))
    target = target.join(before, known).where(ahead).select(*[f"_{c}" for c in group], "_for", "k", "_at", "_u")
    here = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group] + [F.col("block") == F.col("_at")]
    seen = ranked.join(target, here)
    upto = Window.partitionBy(*group, "_for", "k").orderBy("position")
    mine = F.col(part).eqNullSafe(F.col("_for"))
    rank = F.col("position") - F.col("_u") - F.sum(mine.cast("int")).over(upto)
    ends = seen.withColumns({"rank": rank, "mine": mine}).where("not mine and rank = k")
    return ends.groupBy(*group, F.col("_for").alias(part)).agg(((F.min(value) + F.max(value)) / 2).alias("median"))
