"""Dense row numbers in a global order without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task.
Here the rows are range-sorted across many tasks instead. Each task tags its
rows (partition id, position), the sorted table is written once so both uses
below see the same order, and per-partition counts give each partition its
offset. They hold one row per (partition, group); Spark chooses the join by
their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockmap.session import materialize


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Append ``name`` = the sum of ``value`` up to each row in ``order`` (distinct), over many tasks."""
    tagged = materialize(df.orderBy(*order).withColumn("_pid", F.spark_partition_id()), "running")
    totals = tagged.groupBy(F.col("_pid").alias("_pp")).agg(F.sum(value).alias("_t"))
    before = Window.orderBy("_pp").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    totals = totals.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    own = Window.partitionBy("_pid").orderBy(*order)
    return (tagged.withColumn("_in", F.sum(value).over(own)).join(totals, F.col("_pid") == F.col("_pp"))
            .withColumn(name, F.col("_in") + F.col("_off")).drop("_pid", "_pp", "_in", "_off"))


def row_number_global(df: DataFrame, order: Sequence[Column | str], name: str = "rn",
                      within: str | None = None, reread: bool = False) -> DataFrame:
    """Append ``name`` = 1, 2, … in ``order`` (ties broken by the order columns given).

    With ``within`` the numbering restarts for each value of that column
    (rows are sorted by it first). Offsets come from per-(partition, value)
    counts, so a hot group is still spread over many tasks and there is no
    per-group window over the data. ``reread``: ``df`` is little more than a
    scan of files, read twice by the sort rather than written once more.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if within is not None:
        cols = [F.col(within)] + cols
    # The range sort reads its input twice (boundary sample, then the sort):
    # it is written to the shared folder first, where a lost executor loses nothing.
    tagged = materialize((df if reread else materialize(df, "rownum-in")).orderBy(*cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mono", F.monotonically_increasing_id()), "rownum")
    # Counts per (partition, group): a table of #partitions × #groups rows. The
    # running sum over earlier partitions of the same group is the offset, so
    # numbering restarts per group without a second pass over the data.
    grp = F.col(within) if within is not None else F.lit(0)
    per_part = tagged.groupBy(F.col("_pid").alias("_pp"), grp.alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    w = Window.partitionBy("_g").orderBy("_pp").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that Spark knows its size when it chooses the join.
    per_part = materialize(per_part.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n"), "rownum-offsets")
    keys = F.col("_pid") == F.col("_pp")
    if within is not None:
        keys = keys & F.col(within).eqNullSafe(F.col("_g"))
    out = tagged.join(per_part, keys)
    out = out.withColumn(name, F.col("_off") + (F.col("_mono") - F.col("_first")) + 1)
    return out.drop("_pid", "_pp", "_g", "_mono", "_first", "_off")
