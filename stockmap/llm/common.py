"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockmap.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words: space and the control characters tab to carriage return.
WORD_RE = r"[^\x20\x09-\x0D]++"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Spark's ``lower`` has a byte-wise path for pure ASCII; other texts go through ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def prefix_sums(df: DataFrame, order: Sequence[str], value: str, out: str, group: str | None = None,
                name: str = "prefix") -> DataFrame:
    """Append ``out``: the sum of ``value`` over the earlier rows of the same ``group`` in ``order`` (exclusive).

    The rows are range-sorted over many tasks and written once with their
    partition number, so a group that holds a third of all rows spreads over
    many tasks. Each (partition, group) then needs only its own running sum
    plus the totals of earlier partitions, one row for each of them. A unique
    row number breaks ties, so equal rows can be split as well. ``df`` should
    be narrow and cheap to read: the range sort samples it first.
    """
    g = [group] if group else []
    tagged = materialize(
        df.withColumn("_uid", F.monotonically_increasing_id())
        .repartitionByRange(*g, *order, "_uid").sortWithinPartitions(*g, *order, "_uid")
        .withColumn("_pid", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()), name)
    own = Window.partitionBy("_pid", *g).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*(["_og"] if group else [F.lit(0)])).orderBy("_opid").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = tagged.groupBy(F.col("_pid").alias("_opid"), *([F.col(group).alias("_og")] if group else [])).agg(
        F.sum(value).alias("_t"))
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    on = F.col("_pid") == F.col("_opid")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("_og"))
    kind = dict(df.dtypes)[value]
    return (tagged.withColumn("_in", F.coalesce(F.sum(value).over(own), F.lit(0))).join(offsets, on)
            .withColumn(out, (F.col("_in") + F.col("_off")).cast(kind))
            .drop("_uid", "_pid", "_pos", "_in", "_opid", "_og", "_off"))


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct values, rising. ``np.unique`` hashes integers in numpy 2.3, which takes many times as long."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def text_tag(text: Column) -> Column:
    """With the id, names a row in a later read of the same table."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def with_count(docs: DataFrame, tag: Column, counted: DataFrame) -> DataFrame:
    """Each row of ``docs`` as often as ``counted`` says, with all its columns.

    ``counted`` has ``doc_id``, ``tag`` and ``copies`` for each row of ``docs``
    (rows of equal id and tag share the sum of theirs). The join key is nearly
    unique; only where ids and texts repeat, rows of one key are numbered.
    The columns of ``docs`` travel as one struct, so none of their names can clash.
    """
    per = materialize(counted.groupBy("doc_id", "tag").agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).cast("int").alias("rows"))
                      .filter("copies > 0"), "keep")
    columns = [quoted(c) for c in docs.columns]
    d = docs.select(F.struct(*columns).alias("own"), quoted("doc_id").alias("id"), tag.alias("mark"))
    d = d.join(per, d["id"].eqNullSafe(per["doc_id"]) & (d["mark"] == per["tag"]))
    times = F.col("copies")
    if not per.filter("rows > 1").isEmpty():
        place = F.row_number().over(Window.partitionBy("id", "mark").orderBy(F.xxhash64("own")))
        times = F.expr("copies div rows") + F.when(place <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    d = d.withColumn("times", times.cast("int")).filter("times > 0")
    return d.select("own", F.explode(F.sequence(F.lit(1), F.col("times")))).select("own.*")
