"""File sources and sinks: header CSV datasets, TSV gazetteer, JSON-matrix
census files, published loads, manifests and lake reads.

Every reader is lazy and splittable. No file is pulled whole into one task
except where the format forces it (documented per function).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockmap.schemas import DATASET_ORDER, DatasetSpec, spec
from stockmap.sources import commits

# ---------------------------------------------------------------- filesystem helpers

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    fs, p = _fs_path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs_path(spark, old)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"could not move {old} to {new}")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def dataset_dir(root: str, name: str) -> str:
    """Folder of one dataset under a lake root: ``{root}/wa_{name}``."""
    return f"{root.rstrip('/')}/wa_{name}"


# ---------------------------------------------------------------- S1, S4: CSV datasets

#: CSV files of a folder, as they are or compressed.
CSV_FILES, _CSV_ENDS = "{*.csv,*.csv.gz}", (".csv", ".csv.gz")
#: Rows of a compressed file at most.
GZIP_ROWS = 1_000_000


def read_dataset(spark: SparkSession, name: str | DatasetSpec, path: str, *, as_strings: bool = False) -> DataFrame:
    """Header CSV with the declared schema.

    ``enforceSchema=False`` makes Spark check the header against the schema.
    A supplied schema is otherwise applied by position, so reordered columns
    would land in the wrong fields without an error.
    """
    s = spec(name) if isinstance(name, str) else name
    return (spark.read.schema(s.string_schema if as_strings else s.schema)
            .option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
            .option("pathGlobFilter", CSV_FILES).csv(path))


def read_header_csv(spark: SparkSession, path: str | list[str], base: str | None = None) -> DataFrame:
    """Header CSV with whatever columns it has, all strings (used by validation); folders below ``base`` give columns."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("pathGlobFilter", CSV_FILES)
    return (reader.option("basePath", base) if base else reader).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", gzip: bool = False) -> None:
    """Header CSV, one file per partition, no index column. Dates as ISO text, blanks around values as they are.

    With ``gzip`` files are ``*.csv.gz`` (fastest level). One such file is read
    by one task, so none holds more than ``GZIP_ROWS`` rows.
    """
    w = df.write.mode(mode)
    if gzip:
        w = w.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", GZIP_ROWS)
    w.option("header", True).option("dateFormat", "yyyy-MM-dd") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path)


# ---------------------------------------------------------------- S2: gazetteer

def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated gazetteer; header names may carry padding. GEOID stays a string."""
    raw = spark.read.option("header", True).option("sep", "\t").option("inferSchema", False).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    return raw.withColumns({c: finite_or_null(F.col(c).try_cast("double")) for c in ("INTPTLAT", "INTPTLONG")})


def finite_or_null(v: Column) -> Column:
    """NaN is a missing value, not a number."""
    return F.when(~F.isnan(v), v)


def write_gazetteer(df: DataFrame, path: str) -> None:
    """Write rows as a padded-header TSV (the gazetteer's own layout)."""
    padded = df.toDF(*[f"{c:<12}" for c in df.columns])
    padded.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


# ---------------------------------------------------------------- S3: JSON matrix

def read_json_matrix(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """JSON array-of-arrays, the first array of a file names its columns; all values strings.

    Columns go by name: files may have them in another order, or some of them
    only (null elsewhere). By default files are read line by line (one row
    array per line, the layout the census API serves), so they split across
    tasks; a file without a header line takes the header of the others if they
    all agree. ``whole`` reads files that are a single JSON document, on one
    line or many: each is parsed by one task, as the format forces. Only the
    distinct column names come to the driver. A document that is no matrix
    stops the read with an error.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if whole:
        docs = reader.text(path, wholetext=True).where(F.trim("value") != "")
        m = F.from_json("value", "array<array<string>>", {"mode": "FAILFAST"})
        docs = docs.select(m.alias("_m")).select(F.get("_m", F.lit(0)).alias("_cols"), F.col("_m"))
        names = _matrix_names(docs.select("_cols"), path)
        rows = docs.select("_cols", F.posexplode("_m").alias("_at", "_r")).where("_at > 0")
        return rows.select(*[_named(c) for c in names])
    lines = reader.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("_file"))
    body = F.regexp_replace(F.regexp_replace(F.trim("value"), r"^\[+", "["), r"\]*,?\s*$", "")
    arr = F.from_json(F.concat(body, F.lit("]")), "array<string>")
    is_header = F.ltrim("value").startswith("[[")
    headers = lines.where(is_header).groupBy("_file").agg(F.min("value").alias("value")).select("_file", arr.alias("_cols"))
    names = _matrix_names(headers.select("_cols"), path)
    data = lines.where(~is_header & ~F.trim("value").isin("]", "],")).select("_file", arr.alias("_r"))
    kinds = headers.select("_cols").distinct().limit(2).collect()
    if len(kinds) == 1:
        return data.withColumn("_cols", F.array(*[F.lit(c) for c in kinds[0]["_cols"]])).select(*[_named(c) for c in names])
    no_header = F.raise_error(F.concat(F.lit("no header row in "), F.col("_file"))).cast("array<string>")
    rows = data.join(headers, "_file", "left").withColumn("_cols", F.coalesce("_cols", no_header))
    return rows.select(*[_named(c) for c in names])


def _matrix_names(headers: DataFrame, path: str) -> list[str]:
    """All column names of the files, in the order in which they first stand in one."""
    found = headers.select(F.posexplode("_cols").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
    names = [r["name"] for r in found.orderBy("at", "name").collect()]
    if not names:
        raise ValueError(f"no header row in {path}")
    return names


def _named(name: str) -> Column:
    """The value of a row array under ``name``; null if its file has no such column or the row is too short."""
    return F.get("_r", F.array_position("_cols", F.lit(name)) - 1).alias(name)


def write_json_matrix(df: DataFrame, path: str) -> None:
    """Write rows as a line-per-row JSON matrix (header line first file)."""
    spark = df.sparkSession
    import json
    header = "[" + json.dumps(list(df.columns)) + ","
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/00-header")
    row = F.concat(F.to_json(F.array(*[F.col(c).cast("string") for c in df.columns])), F.lit(","))
    df.select(row.alias("value")).write.mode("overwrite").text(f"{path}/10-rows")


# ---------------------------------------------------------------- S5, S6: publish

_REVISION = r"\.rev-[0-9a-f]+$"


def visible_loads(spark: SparkSession, base: str) -> dict[str, str]:
    """``load_ts`` of each load of a dataset that readers see, with the name of its folder.

    The committed manifest decides. A folder that was never published to has
    none; then every ``load_ts=`` folder in it counts.
    """
    state = commits.current(spark, base)
    if state.version:
        return dict(state.body["loads"])
    return {x.removeprefix("load_ts="): x for x in child_names(spark, base) if x.startswith("load_ts=")}


def publish(df: DataFrame, name: str, root: str, load_ts: str, replace: bool = False, gzip: bool = False) -> str:
    """Publish one load of a dataset as ``{root}/wa_{name}/load_ts={load_ts}/*.csv`` (``*.csv.gz`` with ``gzip``).

    Each load is a new folder, so earlier loads stay readable and a flow can
    pick up the new one alone. A load is written aside, moved into place when
    complete, and counts once the dataset's manifest names it (see
    ``sources.commits``): that commit is one step, also where ``replace=True``
    takes the earlier loads out. Their files go after it. So a publish that is
    lost at any point leaves the old loads or the new one, never none and never
    both, and ``df`` may read the dataset itself. Without ``replace``, a load
    under a visible ``load_ts`` raises ``ValueError``; with it, the load takes
    a folder of its own (``load_ts=….rev-…``) until the old one is gone.

    The same write counts the rows and the nulls of the required fields
    (``observe``); the manifest keeps them with the number and bytes of the
    files, for ``load_profiles``.
    """
    spark, base = df.sparkSession, dataset_dir(root, name)
    state, before = commits.current(spark, base), visible_loads(spark, base)
    if not replace and load_ts in before:
        raise ValueError(f"{base}/load_ts={load_ts} exists")
    aside = unique_dir(f"{root.rstrip('/')}/_publishing", name)
    seen = Observation(f"publish-{name}-{uuid.uuid4().hex[:8]}")
    # Header CSV has no empty texts: readers see them as nulls.
    counts = [F.count_if(F.coalesce(F.col(f).cast("string"), F.lit("")) == "").alias(f"n_{f}") for f in spec(name).required if f in df.columns]
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), aside, gzip=gzip)
    profile = {"fields": df.columns, "counts": seen.get, **_file_sizes(spark, aside)}
    folder = f"load_ts={load_ts}"
    if folder in before.values():
        folder += f".rev-{uuid.uuid4().hex[:10]}"
    delete_path(spark, f"{base}/{folder}")  # what a lost publish left
    rename_path(spark, aside, f"{base}/{folder}")
    loads = {load_ts: folder} if replace else {**before, load_ts: folder}
    profiles = {k: v for k, v in {**state.body.get("profiles", {}), load_ts: profile}.items() if k in loads}
    commits.commit(spark, base, state, {"loads": loads, "profiles": profiles})
    commits.kept(spark, base, 1)
    if replace:
        for old in child_names(spark, base):
            if old.startswith("load_ts=") and old != folder:
                delete_path(spark, f"{base}/{old}")
    return f"{base}/{folder}"


def _file_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Number and bytes of the CSV files in a folder, from its listing."""
    fs, p = _fs_path(spark, folder)
    sizes = [x.getLen() for x in fs.listStatus(p) if x.getPath().getName().endswith(_CSV_ENDS)] if fs.exists(p) else []
    return {"files": len(sizes), "bytes": sum(sizes)}


def load_profiles(spark: SparkSession, name: str, root: str) -> list[dict] | None:
    """What the writers of the visible loads counted: ``fields``, ``counts`` (``rows``, ``n_<field>``), ``files``, ``bytes``.

    None unless it covers every visible load and their folders still hold as
    many files and bytes as were written; then only the files themselves tell.
    """
    base = dataset_dir(root, name)
    known = commits.current(spark, base).body.get("profiles", {})
    out = []
    for ts, folder in visible_loads(spark, base).items():
        found = known.get(ts)
        if not found or "rows" not in found["counts"] or not found["files"]:
            return None
        if _file_sizes(spark, f"{base}/{folder}") != {k: found[k] for k in ("files", "bytes")}:
            return None
        out.append(found)
    return out or None


# ---------------------------------------------------------------- S7, A9: manifests

def list_files(spark: SparkSession, root: str, glob: str = CSV_FILES) -> DataFrame:
    """One row per file under ``root``: path, modificationTime, length. Contents are not read."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .load(root).select("path", "modificationTime", "length"))


_DS_FROM_PATH = r"/wa_([^/]+)/"
_LOAD_FROM_PATH = r"/wa_[^/]+/([^/]+)/"
_TS_FROM_PATH = r"load_ts=([^/]+?)(?:\.rev-[0-9a-f]+)?/"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files of the loads that readers see: uploaded_at, dataset, load_ts, path, file_name, bytes."""
    f = list_files(spark, root)
    committed = {x: visible_loads(spark, f"{root.rstrip('/')}/{x}") for x in child_names(spark, root)
                 if x.startswith("wa_") and commits.current(spark, f"{root.rstrip('/')}/{x}").version}
    if committed:
        dataset, load = F.regexp_extract("path", _DS_FROM_PATH, 1), F.regexp_extract("path", _LOAD_FROM_PATH, 1)
        seen = [f"{x}/{folder}" for x, loads in committed.items() for folder in loads.values()]
        f = f.where(~F.concat(F.lit("wa_"), dataset).isin(*committed) | F.concat(F.lit("wa_"), dataset, F.lit("/"), load).isin(*seen))
    return f.select(
        F.col("modificationTime").alias("uploaded_at"),
        F.regexp_extract("path", _DS_FROM_PATH, 1).alias("dataset"),
        F.regexp_extract("path", _TS_FROM_PATH, 1).alias("load_ts"),
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
    )


def file_inventory(spark: SparkSession, root: str, datasets=DATASET_ORDER) -> DataFrame:
    """Per dataset (all names kept, zero when absent): files, bytes, latest modification and file; plus a total row."""
    m = manifest(spark, root)
    names = spark.createDataFrame([(d, i) for i, d in enumerate(datasets)], "dataset string, ord int")
    per = m.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
                                   F.max("uploaded_at").alias("latest_upload"),
                                   F.max_by("file_name", F.struct("uploaded_at", "file_name")).alias("latest_file"))
    j = names.join(per, "dataset", "left").select(
        "dataset", "ord", F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"), "latest_upload", "latest_file")
    total = j.agg(F.lit("TOTAL").alias("dataset"), F.lit(len(datasets)).alias("ord"),
                  F.sum("files").cast("bigint").alias("files"), F.sum("bytes").cast("bigint").alias("bytes"),
                  F.max("latest_upload").alias("latest_upload"), F.lit(None).cast("string").alias("latest_file"))
    return j.unionByName(total)


# ---------------------------------------------------------------- S8: read back

def read_lake(spark: SparkSession, name: str, root: str, snapshot: str = "all") -> DataFrame:
    """A dataset read back from the lake. Only CSV files, plain or gzip, markers skipped.

    Only loads that the dataset's manifest names are read (see ``publish``), so
    a replace that is under way or was lost is never seen in part.
    ``snapshot='all'`` reads every load (``load_ts`` column from the folder
    names); ``'latest'`` reads the folder of the newest load alone. A missing
    dataset or one without files gives an empty table with the declared schema.
    A malformed value stops the read with an error.
    """
    if snapshot not in ("all", "latest"):
        raise ValueError("snapshot must be 'all' or 'latest'")
    base = dataset_dir(root, name)
    schema = T.StructType([*spec(name).schema.fields, T.StructField("load_ts", T.StringType())])
    held = [(ts, f) for ts, f in sorted(visible_loads(spark, base).items(), reverse=True)]
    if snapshot == "latest":
        newest = next((x for x in held if any(n.endswith(_CSV_ENDS) for n in child_names(spark, f"{base}/{x[1]}"))), None)
        held = [newest] if newest else []
    if not held:
        return spark.createDataFrame([], schema)
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
          .option("pathGlobFilter", CSV_FILES).option("basePath", base).csv([f"{base}/{f}" for _, f in held]))
    return df.withColumn("load_ts", F.regexp_replace("load_ts", _REVISION, ""))


def read_loads_as_text(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The files of the visible loads with whatever columns they have, all strings, and ``load_ts``."""
    base = dataset_dir(root, name)
    held = [f"{base}/{f}" for f in visible_loads(spark, base).values()]
    return read_header_csv(spark, held or base, base)


# ---------------------------------------------------------------- S9: cached raw input

def cached(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` as Parquet at ``path`` the first time; read it back afterwards."""
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def unique_dir(base: str, label: str) -> str:
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:10]}"
