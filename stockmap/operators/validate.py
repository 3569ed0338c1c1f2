"""Dataset validation: required / forbidden fields, empty datasets, nulls, key duplicates.

Schema checks (V1, V2) read metadata only. Content checks (V3, V4) run as a
single aggregate pass per dataset: one ``count`` plus one ``count_if`` per
required field, with a partial aggregate per task and one row to the driver.
``validate_published`` makes no pass where the writing job has counted both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmap.schemas import DATASET_ORDER, spec
from stockmap.sources.files import dataset_dir, load_profiles, path_exists, read_loads_as_text

RESULT_SCHEMA = "dataset string, check string, field string, message string"
NULLS_SCHEMA = "dataset string, field string, null_count bigint"
# The message texts are fixed values.
MISSING, FORBIDDEN = "Missing required field: %s", "Forbidden field present: %s"
EMPTY, NULLS, UNREADABLE = "Dataset is empty", "Field '%s' has %d null values", "File not found"


def _profile(df: DataFrame, dataset: str) -> DataFrame:
    """One row: rows, and null counts of the required fields present."""
    present = [f for f in spec(dataset).required if f in df.columns]
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(f).isNull()).alias(f"n_{f}") for f in present])


def null_counts(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, field, null_count) for each required field present (V4)."""
    present = [f for f in spec(dataset).required if f in df.columns]
    prof = _profile(df, dataset)
    if not present:
        return df.sparkSession.createDataFrame([], NULLS_SCHEMA)
    stack = prof.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").cast("bigint").alias("null_count")) for f in present
    ])).alias("_n"))
    return stack.select(F.lit(dataset).alias("dataset"), "_n.field", "_n.null_count")


def _schema_failures(dataset: str, columns: list[str]) -> list[tuple]:
    s = spec(dataset)
    return [(dataset, "missing_required", f, MISSING % f) for f in s.required if f not in columns] + \
        [(dataset, "forbidden_present", f, FORBIDDEN % f) for f in s.forbidden if f in columns]


def validate_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """Failure rows (dataset, check, field, message) for one dataset; none when valid."""
    spark = df.sparkSession
    s = spec(dataset)
    out = spark.createDataFrame(_schema_failures(dataset, df.columns), RESULT_SCHEMA)
    present = [f for f in s.required if f in df.columns]
    prof = _profile(df, dataset)
    checks = [F.when(F.col("rows") == 0, F.struct(F.lit("empty").alias("check"), F.lit(None).cast("string")
                                                 .alias("field"), F.lit(EMPTY).alias("message")))]
    for f in present:
        n = F.col(f"n_{f}")
        checks.append(F.when(n > 0, F.struct(F.lit("nulls").alias("check"), F.lit(f).alias("field"),
                                             F.format_string(NULLS, F.lit(f), n).alias("message"))))
    content = (prof.select(F.explode(F.array(*checks)).alias("_c")).where(F.col("_c").isNotNull())
               .select(F.lit(dataset).alias("dataset"), "_c.check", "_c.field", "_c.message"))
    return out.unionByName(content)


def open_datasets(spark: SparkSession, root: str, datasets=DATASET_ORDER) -> dict[str, DataFrame | None]:
    """Each dataset opened from its files under ``root`` as text columns; None where no file is or none can be opened."""
    out: dict[str, DataFrame | None] = {}
    for name in datasets:
        path = dataset_dir(root, name)
        try:
            df = read_loads_as_text(spark, name, root) if path_exists(spark, path) else None
        except AnalysisException:  # a folder without files
            df = None
        # Files without a header have no columns but those of their folders.
        out[name] = df if df is not None and set(df.columns) - {"load_ts"} else None
    return out


def dataset_profile(spark: SparkSession, frames: Mapping[str, DataFrame | None], datasets=DATASET_ORDER) -> DataFrame:
    """Per dataset that can be opened: rows, number of fields, key fields and the number of keys that occur twice or more."""
    parts = []
    for name in datasets:
        df, s = frames.get(name), spec(name)
        if df is None:
            continue
        fields = [c for c in df.columns if c != "load_ts"]
        key = [k for k in s.key if k in fields]
        counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")) if key else df.limit(0).select(F.lit(1).alias("_n"))
        parts.append(counted.agg(
            F.lit(name).alias("dataset"), F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"), F.lit(len(fields)).alias("field_count"),
            F.lit(",".join(s.key)).alias("key_fields"), F.count_if(F.col("_n") > 1).alias("duplicate_keys")))
    out = spark.createDataFrame([], "dataset string, rows bigint, field_count int, key_fields string, duplicate_keys bigint")
    for p in parts:
        out = out.unionByName(p)
    return out


def validate_all(spark: SparkSession, frames: Mapping[str, DataFrame | None],
                 datasets=DATASET_ORDER) -> DataFrame:
    """Failure rows for every dataset name; a missing/unreadable dataset is one failure row."""
    parts = []
    missing = []
    for name in datasets:
        df = frames.get(name)
        if df is None:
            missing.append((name, "unreadable", None, UNREADABLE))
        else:
            parts.append(validate_dataset(df, name))
    out = spark.createDataFrame(missing, RESULT_SCHEMA)
    for p in parts:
        out = out.unionByName(p)
    return out


def validate_published(spark: SparkSession, root: str, datasets=DATASET_ORDER) -> DataFrame:
    """``validate_all`` of what is published under ``root``, from the counts of the writing jobs where they hold.

    A dataset whose manifest has no counts for all its loads, whose loads
    differ in their fields or whose files are no longer those that were
    written is opened and read. Nothing but the manifests (one small file a
    dataset) and folder listings is read for the others.
    """
    found: list[tuple] = []
    opened: list[str] = []
    for name in datasets:
        loads = load_profiles(spark, name, root)
        if loads is None or any(x["fields"] != loads[0]["fields"] for x in loads):
            opened.append(name)
            continue
        counts = {k: sum(x["counts"][k] for x in loads) for k in loads[0]["counts"]}
        found += _schema_failures(name, [*loads[0]["fields"], "load_ts"])
        if not counts["rows"]:
            found.append((name, "empty", None, EMPTY))
        found += [(name, "nulls", k.removeprefix("n_"), NULLS % (k.removeprefix("n_"), n)) for k, n in counts.items() if k != "rows" and n]
    out = spark.createDataFrame(found, RESULT_SCHEMA)
    return out.unionByName(validate_all(spark, open_datasets(spark, root, opened), opened)) if opened else out


def validate_summary(spark: SparkSession, failures: DataFrame, datasets=DATASET_ORDER) -> DataFrame:
    """Per dataset: errors and valid flag; plus an ``ALL`` row with n valid of n (V5)."""
    names = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    per = failures.groupBy("dataset").agg(F.count(F.lit(1)).alias("errors"))
    j = names.join(per, "dataset", "left").select(
        "dataset", F.coalesce("errors", F.lit(0)).cast("bigint").alias("errors"))
    j = j.withColumn("valid", F.col("errors") == 0)
    total = j.agg(F.lit("ALL").alias("dataset"), F.sum("errors").cast("bigint").alias("errors"),
                  (F.count_if("valid") == F.count(F.lit(1))).alias("valid"),
                  F.count_if("valid").cast("bigint").alias("valid_datasets"),
                  F.count(F.lit(1)).cast("bigint").alias("total_datasets"))
    j = j.withColumns({"valid_datasets": F.lit(None).cast("bigint"), "total_datasets": F.lit(None).cast("bigint")})
    return j.unionByName(total)


def key_duplicates(df: DataFrame, dataset: str, key: tuple[str, ...] | None = None) -> DataFrame:
    """Keys that occur more than once: key columns + occurrences (V6)."""
    k = list(key or spec(dataset).key)
    return (df.groupBy(*k).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1).select(F.lit(dataset).alias("dataset"), *k, "occurrences"))
