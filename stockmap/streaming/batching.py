"""Event batches over arriving records (I6): numbering goes on where the last micro-batch stopped.

Records of a dataset are numbered in the order of their arrival (micro-batch,
then ``order`` within it), and every ``batch_size`` of them make one batch,
however the arrivals were cut into micro-batches or runs. Between micro-batches
the state is the last number and the open batch of each dataset: at most
``batch_size - 1`` records a dataset, and the datasets that are sent are a
fixed list.

A keyed state operator would take all records of a dataset through one task.
Here the state is a commit of the target folder instead (``sources.commits``),
and each micro-batch is numbered by a range sort over many tasks, so a dataset
that holds most records is spread like any other. Files of a micro-batch are
written before its commit and count from then on: one that is lost before it
leaves nothing visible, one replayed after it is skipped.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmap.operators.conform import BATCH_SIZE, PIECE_SCHEMA, as_events, batch_pieces, numbered_records, torn_batches
from stockmap.session import materialize
from stockmap.sources import commits
from stockmap.sources.files import child_names, delete_path
from stockmap.streaming.flows import finish, stream_id


def add_records(payloads: DataFrame, batch_id: int, target: str, *, order: Sequence[str], batch_size: int = BATCH_SIZE,
                stream: str = "batch", reread: bool = False) -> bool:
    """Add one micro-batch of ``stream`` (dataset, record_key, payload) to ``target``. False when it was already committed.

    Records of datasets that are not sent are left out (``conform.split_routed``
    gives them). The ids of a stream's micro-batches rise. Records that are
    equal in all of ``order`` take any order among themselves. ``reread``:
    ``payloads`` is little more than a scan of files, which is read twice.
    Full pieces go from their table to the closed batches as they are; only
    those across two tasks or micro-batches are written in between.
    """
    spark = payloads.sparkSession
    state = commits.current(spark, target)
    body = state.body or {"batch_size": batch_size, "last": {}, "streams": {}, "open": None}
    if body["batch_size"] != batch_size:
        raise ValueError(f"{target} was written with batches of {body['batch_size']} records, not {batch_size}")
    if batch_id <= body["streams"].get(stream, -1):
        return False
    numbered = numbered_records(payloads, list(order), reread=reread)
    if body["last"]:
        last = F.create_map(*[F.lit(x) for kv in body["last"].items() for x in kv])
        numbered = numbered.withColumn("rn", F.col("rn") + F.coalesce(last[F.col("dataset")], F.lit(0)))
    pieces = batch_pieces(numbered, batch_size)
    if body["open"]:
        pieces = pieces.unionByName(_read(spark, f"{target}/open/{body['open']}"))
    torn = materialize(torn_batches(pieces, batch_size), "event-batches")
    # One row for each dataset that is sent.
    reached = pieces.groupBy("dataset").agg(F.max(F.col("first") + F.col("records") - 1).alias("n")).collect()
    write = f"{stream}-{batch_id}-{uuid.uuid4().hex[:10]}"
    whole = F.col("records") == batch_size
    torn.where(~whole).coalesce(1).write.parquet(f"{target}/open/{write}")
    # A folder for each stream and micro-batch: a replay writes over what its lost try left there.
    pieces.where(whole).unionByName(torn.where(whole)).write.mode("overwrite").parquet(f"{target}/closed/_stream={stream}/_batch={batch_id}")
    commits.commit(spark, target, state, {
        **body, "open": write, "last": {**body["last"], **{r["dataset"]: r["n"] for r in reached}},
        "streams": {**body["streams"], stream: batch_id}})
    commits.kept(spark, target, 1)
    for old in child_names(spark, f"{target}/open"):
        if old not in (write, body["open"]):  # a reader may still hold the version before this one
            delete_path(spark, f"{target}/open/{old}")
    return True


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PIECE_SCHEMA).parquet(path)


def read_batches(spark: SparkSession, target: str, group_ts: str) -> DataFrame:
    """All batches so far, as ``conform.event_batches`` gives them, and ``closed``: whether the batch is full.

    An open batch is the last of its dataset; it grows with later records.
    """
    state = commits.current(spark, target)
    if not state.version:
        raise FileNotFoundError(f"{target} has no batches yet")
    body = state.body
    done = F.lit(False)
    for stream, newest in body["streams"].items():
        done = done | ((F.col("_stream") == stream) & (F.col("_batch") <= newest))
    closed = (spark.read.schema(f"{PIECE_SCHEMA}, _stream string, _batch long").option("basePath", f"{target}/closed")
              .parquet(f"{target}/closed").where(done).drop("_stream", "_batch"))
    found = as_events(closed.unionByName(_read(spark, f"{target}/open/{body['open']}")), group_ts)
    return found.withColumn("closed", F.col("records") == body["batch_size"])


def batch_stream(stream: DataFrame, target: str, checkpoint_dir: str, *, order: Sequence[str], batch_size: int = BATCH_SIZE,
                 timeout_s: float | None = None, reread: bool = False) -> None:
    """Run a stream of (dataset, record_key, payload) to completion (availableNow), adding each micro-batch to ``target``."""
    def add(df: DataFrame, batch_id: int) -> None:
        add_records(df, batch_id, target, order=order, batch_size=batch_size, stream=stream_id(df.sparkSession, checkpoint_dir), reread=reread)

    q = stream.writeStream.foreachBatch(add).trigger(availableNow=True).option("checkpointLocation", checkpoint_dir).start()
    finish(q, timeout_s)
