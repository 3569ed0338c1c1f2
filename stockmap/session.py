"""Session helpers.

Operators never create a session; they take DataFrames. These helpers are for
tests, the bench and the command line, and for reading cluster settings.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every Stockmap job relies on. Session zone UTC: the data model's
# instants are UTC (`…T00:00:00Z`); dates must not shift with the driver zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "stockmap") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder that the driver and
    all executors share, and is used as is. Where it is unset, a private
    folder is made for a local session only; on a cluster that is an error,
    since executors could not read what the others wrote.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="stockmap-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A folder of this application below the checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stockmap/{spark.sparkContext.applicationId}/{name}".rstrip("/")


def materialize(df, name: str, metrics=None):
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    This cuts the lineage the way ``checkpoint()`` does. It costs one job, the
    files survive executor loss, and their sizes give AQE real statistics for
    later join choices. ``metrics`` (aggregate columns) are collected by the
    same write job through ``observe``; the call then returns
    ``(df, metrics_dict)``.
    """
    import uuid

    from pyspark.sql import Observation

    spark = df.sparkSession
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    obs = None
    if metrics:
        obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *metrics)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)  # known schema: no footer inference
    return (out, obs.get) if obs is not None else out


def run_side_by_side(spark: SparkSession, *work) -> list:
    """Results of independent functions whose jobs run at the same time, under the caller's job group and tags."""
    from pyspark import InheritableThread

    out: list = [None] * len(work)

    def run(i: int) -> None:
        try:
            out[i] = work[i](), None
        except Exception as e:  # raised again below, in the caller's thread
            out[i] = None, e

    threads = [InheritableThread(target=run, args=(i,), session=spark) for i in range(len(work))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for _, e in out:
        if e is not None:
            raise e
    return [x for x, _ in out]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote; those of other applications stay.

    Call it once the results that read them have been written or collected;
    a DataFrame returned by an operator may still read these files until then.
    """
    path = scratch_dir(spark)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
