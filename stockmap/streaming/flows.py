"""Incremental file flows (Structured Streaming) with an execution log.

A flow watches a folder of header CSV files, applies SQL to each micro-batch
(``SELECT * FROM {source}`` by default), adds the result to a Parquet target
and logs one execution row per batch. Only new files are loaded: the file
source's checkpoint records which files were read. A run uses
``trigger(availableNow=True)``: it loads everything new, then stops.

Target and log hold one folder for each batch, ``_run=<stream id>/_batch=<n>``,
written with overwrite. The stream id lives in the checkpoint folder, so a
batch replayed after a lost commit replaces what it wrote before, and a fresh
checkpoint (a re-trigger) adds new folders.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmap.sources.files import delete_path

LOG_SCHEMA = T.StructType([
    T.StructField("flow_name", T.StringType()),
    T.StructField("execution_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("messages", T.ArrayType(T.StructType([T.StructField("type", T.StringType()),
                                                        T.StructField("message", T.StringType())]))),
    T.StructField("records_processed", T.LongType()),
    T.StructField("records_failed", T.LongType()),
    T.StructField("bytes_processed", T.LongType()),
])

CORRUPT = "_corrupt_record"
#: The log rows of a batch: at its beginning and at its end.
_FIRST, _LAST = 0, 1


def source_name(dataset: str) -> str:
    """Per-dataset source view name used in flow SQL."""
    return f"wa_{dataset}_src"


def run_flow(spark: SparkSession, *, flow_name: str, source_dir: str, schema: T.StructType, target_dir: str,
             checkpoint_dir: str, log_dir: str, sql: str = "SELECT * FROM {source}", source: str = "src",
             rejects_dir: str | None = None, timeout_s: float | None = None) -> None:
    """Load new files from ``source_dir`` into ``target_dir`` and add execution rows to ``log_dir``.

    The header of every file must name the columns of ``schema`` in order;
    other headers fail the batch. Rows that do not parse are counted as failed
    (``_corrupt_record``) and not loaded; with ``rejects_dir`` they are kept
    there (``file``, ``record``, ``reason``), one folder for each batch like the
    target's. A batch is logged as RUNNING when it begins, and its last row
    takes that one's place, so a run that is lost stays RUNNING. Bytes processed are the sizes of the
    batch's files (from ``_metadata``). A failing batch is logged FAILED with
    its whole message and what it counted, and the error is raised again, so
    the stream stops and does not commit the batch. ``timeout_s`` stops a run
    early (for tests); by default a run takes as long as it needs.
    """
    read_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(read_schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.csv")
              .csv(source_dir).withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_size", F.col("_metadata.file_size")))

    def load(batch: DataFrame, batch_id: int) -> None:
        start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        session, err, msgs = batch.sparkSession, None, []
        n = bad = size = 0
        place = f"_run={stream_id(session, checkpoint_dir)}/_batch={batch_id}"
        # A replayed batch runs again, whatever its last try has logged.
        delete_path(session, f"{log_dir}/{place}/_phase={_LAST}")
        _log(session, f"{log_dir}/{place}/_phase={_FIRST}", (flow_name, f"{flow_name}-{batch_id}", "RUNNING", start, None, [], 0, 0, 0))
        view = f"{source}_{flow_name}_{batch_id}".replace("-", "_")
        try:
            # One scan: rows and failed rows for each file, then their sums. Every column is read, since the
            # reader parses (and rejects) only what a query asks for.
            whole = F.max(F.xxhash64(*schema.names)).alias("whole")
            st = batch.groupBy("_file", "_size").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"), whole).agg(
                F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("_size").alias("size"), F.max("whole")).first()
            n, bad, size = st["n"] or 0, st["bad"] or 0, st["size"] or 0
            if rejects_dir is not None:
                rejected(batch, schema).write.mode("overwrite").parquet(f"{rejects_dir}/{place}")
            batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file", "_size").createOrReplaceTempView(view)
            session.sql(sql.replace("{source}", view)).write.mode("overwrite").parquet(f"{target_dir}/{place}")
        except Exception as e:  # logged, then raised again below
            err, msgs = e, [("ERROR", str(e))]
        finally:
            session.catalog.dropTempView(view)
        end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (flow_name, f"{flow_name}-{batch_id}", "FAILED" if err else "SUCCEEDED", start, end, msgs, int(n), int(bad), int(size))
        _log(session, f"{log_dir}/{place}/_phase={_LAST}", row)
        if err is not None:
            raise err

    q = (stream.writeStream.foreachBatch(load).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_dir).queryName(f"flow_{flow_name}".replace("-", "_")).start())
    finish(q, timeout_s)


def _log(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def rejected(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of ``batch`` that did not parse: file, record (as it came) and reason.

    Every column is asked for, since the reader rejects only by those that are.
    """
    text = F.from_csv(F.col("record"), ", ".join(f"`{f.name}` string" for f in schema.fields))
    misfit = F.array_compact(F.array(*[F.when(F.col(f"_t.`{f.name}`").isNotNull() & F.col(f"_t.`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]))
    rows = batch.where(F.col(CORRUPT).isNotNull() & F.xxhash64(*schema.names).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record"))
    reason = F.when(F.size("_misfit") > 0, F.concat(F.lit("value does not fit: "), F.array_join("_misfit", ", "))).otherwise("wrong number of fields")
    return rows.withColumn("_t", text).withColumn("_misfit", misfit).select("file", "record", reason.alias("reason"))


def finish(q, timeout_s: float | None) -> None:
    """Wait for a stream's end, without a limit unless one is given."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {q.name} did not finish in {timeout_s}s")


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id that Structured Streaming keeps in a checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint_dir}/metadata").first()["value"])["id"]


def read_loaded(spark: SparkSession, target_dir: str) -> DataFrame:
    """What the flow's batches have loaded."""
    return spark.read.parquet(target_dir).drop("_run", "_batch")


def read_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """One row for each batch: its last one, or the one from its beginning while it runs (or if it was lost)."""
    rows = spark.read.schema(LOG_SCHEMA).parquet(log_dir)
    last = rows.groupBy("_run", "_batch").agg(F.max_by(F.struct(*LOG_SCHEMA.names), "_phase").alias("row"))
    return last.select("row.*")


def read_rejects(spark: SparkSession, rejects_dir: str) -> DataFrame:
    """What the flow's batches have rejected: file, record, reason."""
    return spark.read.schema("file string, record string, reason string").parquet(rejects_dir).select("file", "record", "reason")


# ---------------------------------------------------------------- windowed event counts

def events_daily_stream(events: DataFrame, ts: str = "ts", kind: str = "event_type",
                        watermark: str | None = "1 day") -> DataFrame:
    """Streaming daily counts per event type.

    With a watermark (for ``append``) a window is final, and its state goes,
    once events later than its end by that much have come; without one (for
    ``complete``) every window stays open. ``ts`` may be TIMESTAMP_NTZ; the
    watermark needs TIMESTAMP, so it is cast first (session zone UTC).
    """
    e = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark is not None:
        e = e.withWatermark("_ts", watermark)
    g = e.groupBy(F.window("_ts", "1 day").alias("w"), F.col(kind)).agg(F.count(F.lit(1)).alias("events"))
    return g.select(F.to_date(F.col("w.start")).alias("day"), F.col(kind).alias("event_type"), "events")


def run_to_table(df: DataFrame, checkpoint_dir: str, out_dir: str, mode: str = "complete",
                 timeout_s: float | None = None) -> None:
    """Run a streaming aggregate to completion (availableNow) and write its result as Parquet.

    ``complete`` replaces the result with each batch and keeps every window in
    state. ``append`` writes a window once the watermark has passed it, one
    folder for each batch, and drops its state; late rows beyond the watermark
    are left out, as the watermark promises.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir if mode == "complete" else f"{out_dir}/_batch={batch_id}")

    q = (df.writeStream.outputMode(mode).foreachBatch(sink).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_dir).start())
    finish(q, timeout_s)
