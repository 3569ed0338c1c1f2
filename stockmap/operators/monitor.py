"""Monitoring over flow execution logs and integration events.

Executions: flow_name, execution_id, start_time, status, records_processed,
records_failed, [end_time, messages array<struct<type,message>>, bytes_processed].
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUNNING_STATES = ("RUNNING", "IN_PROGRESS")


def execution_stats(flows: DataFrame, executions: DataFrame) -> DataFrame:
    """One row: flows with/without executions, executions by status class, success rate %.

    Executions are reduced to one row per flow (partial aggregate) before
    they meet the flow list, so the join carries #flows rows.
    """
    st = F.col("status")
    per_flow = executions.groupBy("flow_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(st == "SUCCEEDED").alias("ok"),
        F.count_if(st == "FAILED").alias("failed"),
        F.count_if(st.isin(*RUNNING_STATES)).alias("running"))
    j = flows.select("flow_name").join(per_flow, "flow_name", "left").fillna(0, ["n", "ok", "failed", "running"])
    return j.agg(
        F.count(F.lit(1)).alias("total_flows"),
        F.count_if(F.col("n") > 0).alias("flows_with_executions"),
        F.count_if(F.col("n") == 0).alias("flows_without_executions"),
        F.sum("n").cast("bigint").alias("total_executions"),
        F.sum("ok").cast("bigint").alias("succeeded"),
        F.sum("failed").cast("bigint").alias("failed"),
        F.sum("running").cast("bigint").alias("running"),
        (F.sum("n") - F.sum("ok") - F.sum("failed") - F.sum("running")).cast("bigint").alias("other"),
    ).withColumn("success_rate_pct", F.round(
        F.try_divide(F.col("succeeded").cast("double"), F.nullif(F.col("total_executions"), F.lit(0))) * 100, 6))


def recent_executions(executions: DataFrame, n: int = 3) -> DataFrame:
    """Latest ``n`` executions per flow (start desc, execution_id).

    ``row_number() <= n`` lets Spark insert a per-task group limit before the
    shuffle (WindowGroupLimit), so a flow with a huge history sends at most
    ``n`` rows per task.
    """
    w = Window.partitionBy("flow_name").orderBy(F.col("start_time").desc(), F.col("execution_id"))
    return executions.withColumn("recent_rank", F.row_number().over(w)).where(F.col("recent_rank") <= n)


def recent_events(events: DataFrame, n: int = 20, ts: str = "event_timestamp", key: str = "event_id") -> DataFrame:
    """Latest ``n`` events overall, ranked (top-k: per-task top n, then a merge)."""
    order = [F.col(ts).desc(), F.col(key)]
    top = events.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def failed_executions(executions: DataFrame, max_messages: int | None = None) -> DataFrame:
    """Failed executions with all their messages, one row per message (or one row with null message when
    there are none), or with the first ``max_messages`` of each for a short report."""
    f = executions.where(F.col("status") == "FAILED")
    all_ = F.coalesce("messages", F.array().cast("array<struct<type:string,message:string>>"))
    f = f.withColumn("_m", all_ if max_messages is None else F.slice(all_, 1, max_messages))
    e = f.select("*", F.posexplode_outer("_m").alias("_pos", "_msg"))
    return e.select(
        "flow_name", "execution_id", "start_time", "end_time", "records_processed", "records_failed", "bytes_processed",
        (F.col("_pos") + 1).cast("int").alias("message_no"), F.col("_msg.type").alias("message_type"),
        F.col("_msg.message").alias("message"))


def flow_throughput(executions: DataFrame) -> DataFrame:
    """Per flow: executions, records processed / failed, bytes (when logged)."""
    aggs = [F.count(F.lit(1)).alias("executions"),
            F.sum("records_processed").cast("bigint").alias("records_processed"),
            F.sum("records_failed").cast("bigint").alias("records_failed")]
    if "bytes_processed" in executions.columns:
        aggs.append(F.sum("bytes_processed").cast("bigint").alias("bytes_processed"))
    return executions.groupBy("flow_name").agg(*aggs)
