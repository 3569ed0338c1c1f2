"""Keyed UPSERT of change events into a versioned, bucketed Parquet table.

Layout: ``{target}/data/_write=<id>/_bucket=k/`` holds the rows of one bucket
(k = pmod(hash(key), buckets)) as one batch wrote them, and is never changed.
A version of the table is a list that names one such folder for each bucket;
it lies in a manifest, and a pointer file names the manifest that counts (see
``sources.commits``). One micro-batch:

1. reduce the batch to the latest event per key (``max_by`` on ``order``);
2. read only the buckets the batch touches, as the current version has them,
   and keep the latest per key of both;
3. write the merged buckets as new folders;
4. commit a version that takes these folders for the touched buckets and the
   old ones for all others, together with the id of the batch.

A reader sees the version that is current when it opens the table, old or new
but whole, and its files stay for the last ``keep`` versions; older ones go
after a commit. A batch id that its stream has committed is skipped, and what a
lost batch has written is in no version, so replays are idempotent whatever
step they were lost at. A batch with another number of buckets is refused, as
its keys would fall into other buckets.

Only touched buckets are rewritten, so a batch costs its own size plus the
size of the buckets it hits, not the whole table. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmap.session import materialize
from stockmap.sources import commits
from stockmap.sources.files import child_names, delete_path
from stockmap.streaming.flows import finish, stream_id

#: Tasks that write one bucket, so that a hot bucket is not one task's work.
WRITERS = 4
#: Versions whose files stay.
KEEP = 2


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (lexicographic)."""
    cols = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*cols), F.struct(*[F.col(o) for o in order]))
    return df.groupBy(*key).agg(best.alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def _bucket(key: Sequence[str], buckets: int):
    return F.pmod(F.hash(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def _read_buckets(spark: SparkSession, target: str, body: dict, wanted: Sequence[str] | None = None) -> DataFrame:
    """The rows of the ``wanted`` buckets (all by default) of one version."""
    schema = T.StructType.fromJson(json.loads(body["schema"]))
    paths = [f"{target}/data/_write={write}/_bucket={k}" for k, write in body["folders"].items() if wanted is None or k in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)


def upsert_batch(batch: DataFrame, batch_id: int, target: str, *, key: Sequence[str], order: Sequence[str],
                 buckets: int = 64, stream: str = "", keep: int = KEEP) -> bool:
    """Merge one batch of ``stream`` into ``target``. Returns False when it was already committed.

    The ids of a stream's batches rise, as those of Structured Streaming do.
    """
    spark = batch.sparkSession
    state = commits.current(spark, target)
    body = state.body or {"buckets": buckets, "folders": {}, "batches": {}, "schema": batch.schema.json()}
    if body["buckets"] != buckets:
        raise ValueError(f"{target} was written with {body['buckets']} buckets, not {buckets}")
    if batch_id <= body["batches"].get(stream, -1):
        return False
    new = materialize(latest_per_key(batch, key, order).withColumn("_bucket", _bucket(key, buckets)), "upsert-batch")
    touched = [str(r["_bucket"]) for r in new.select("_bucket").distinct().collect()]  # at most `buckets` values
    write = f"{state.version + 1}-{uuid.uuid4().hex[:10]}"
    if touched:
        old = _read_buckets(spark, target, body, touched).withColumn("_bucket", _bucket(key, buckets))
        merged = latest_per_key(old.unionByName(new), [*key, "_bucket"], order)
        part = F.pmod(F.xxhash64(*key), F.lit(WRITERS))
        merged.repartition("_bucket", part).write.partitionBy("_bucket").parquet(f"{target}/data/_write={write}")
    commits.commit(spark, target, state, {
        **body, "folders": {**body["folders"], **{k: write for k in touched}},
        "batches": {**body["batches"], stream: batch_id}, "before": commits.manifest_name(spark, target)})
    expire(spark, target, keep)
    return True


def expire(spark: SparkSession, target: str, keep: int = KEEP) -> None:
    """Remove the folders that none of the last ``keep`` versions names, lost batches' among them."""
    named = {(write, k) for v in commits.kept(spark, target, keep) for k, write in v.body.get("folders", {}).items()}
    writes = {w for w, _ in named}
    for folder in child_names(spark, f"{target}/data"):
        write = folder.removeprefix("_write=")
        if write not in writes:
            delete_path(spark, f"{target}/data/{folder}")
            continue
        for bucket in child_names(spark, f"{target}/data/{folder}"):
            if bucket.startswith("_bucket=") and (write, bucket.removeprefix("_bucket=")) not in named:
                delete_path(spark, f"{target}/data/{folder}/{bucket}")


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The current version of the table, whole."""
    state = commits.current(spark, target)
    if not state.version:
        raise FileNotFoundError(f"{target} has no version yet")
    return _read_buckets(spark, target, state.body)


def upsert_stream(stream: DataFrame, target: str, checkpoint_dir: str, *, key: Sequence[str],
                  order: Sequence[str], buckets: int = 64, timeout_s: float | None = None) -> None:
    """Run a change stream to completion (availableNow), merging each micro-batch.

    Batches are known by the stream's id in its checkpoint folder: a fresh
    checkpoint is another stream, and its first batch is no replay.
    """
    def merge(df: DataFrame, batch_id: int) -> None:
        upsert_batch(df, batch_id, target, key=key, order=order, buckets=buckets, stream=stream_id(df.sparkSession, checkpoint_dir))

    q = stream.writeStream.foreachBatch(merge).trigger(availableNow=True).option("checkpointLocation", checkpoint_dir).start()
    finish(q, timeout_s)
