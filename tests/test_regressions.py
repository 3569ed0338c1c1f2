"""Cases that once went wrong: cuts, caps, lost data, NaN, co-located sites."""

import os

import pytest
from pyspark.sql import functions as F

from stockmap import fixtures as fx
from stockmap.operators import coverage as cov
from stockmap.operators import monitor as mo
from stockmap.operators import supply as sp
from stockmap.plans.nearest import nearest_site
from stockmap.schemas import spec
from stockmap.sources import files as fs
from stockmap.streaming import flows as fl
from stockmap.streaming import upsert as up

ORDER = spec("inbound_order")


def test_order_ids_pad_and_never_cut(spark):
    c = spark.createDataFrame([(f"C{i}", "X", "CLINIC", i) for i in (1, 123, 1234, 1239)], "id string, city string, customer_type string, seq long")
    s = spark.createDataFrame([("S1", sp.HUB, "X")], "site_id string, site_type string, city string")
    ids = [r.cust_order_id for r in sp.outbound_demand(c, s, "2024-01-01").collect()]
    assert len(set(ids)) == 8 and "CUST-ORDER-001-NORMAL" in ids and "CUST-ORDER-1234-NORMAL" in ids


def test_codes_are_unique_past_100000_keys(spark):
    k = spark.range(1, 300_001).select(fx.code(F.col("id"), 7919).alias("c"))
    assert k.distinct().count() == 300_000
    assert k.filter(F.length("c") == 5).count() == 99_999


def test_closure_of_a_deep_chain_and_of_a_wide_tree(spark):
    chain = spark.range(120).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("p"))
    c = sp.hierarchy_closure(spark, chain, "id", "p")
    assert c.count() == 120 * 121 // 2 and c.agg(F.max("distance")).first()[0] == 119
    assert c.filter("cast(id as int) - cast(ancestor_id as int) <> distance").isEmpty()
    wide = spark.range(600_000).select("id", F.when(F.col("id") > 0, F.floor((F.col("id") - 1) / 1000)).alias("p"))
    assert sp.hierarchy_closure(spark, wide, "id", "p").agg(F.max("distance")).first()[0] == 2


def test_closure_with_missing_parent_and_cycle(spark):
    lost = spark.createDataFrame([("a", "b"), ("b", "gone")], "id string, p string")
    got = {tuple(r) for r in sp.hierarchy_closure(spark, lost, "id", "p").collect()}
    assert got == {("a", "a", 0), ("b", "b", 0), ("a", "b", 1), ("b", "gone", 1), ("a", "gone", 2)}
    with pytest.raises(ValueError):
        sp.hierarchy_closure(spark, spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "id string, p string"), "id", "p")


@pytest.mark.parametrize("descent", [None, True, False])
def test_nearest_other_at_the_same_point(spark, descent):
    rows = [("A", 47.0, -120.0), ("B", 47.0, -120.0), ("C", 48.0, -120.0), ("D", 47.0, -120.0)]
    s = spark.createDataFrame(rows, "site_id string, latitude double, longitude double")
    got = {r.site_id: (r.nearest_site_id, round(r.distance_km)) for r in nearest_site(s, s, zone_key="site_id", descent=descent).collect()}
    assert got == {"A": ("B", 0), "B": ("A", 0), "C": ("A", 111), "D": ("A", 0)}


def test_nan_coordinates_are_missing(spark):
    z = spark.createDataFrame([("1", float("nan"), -120.0), ("2", 47.0, -120.0), ("3", None, None)], "zip_code string, latitude double, longitude double")
    s = spark.createDataFrame([("A", 47.0, -120.0), ("N", float("nan"), float("nan"))], "site_id string, latitude double, longitude double")
    got = {r.zip_code: r.nearest_site_id for r in nearest_site(z, s).collect()}
    assert got == {"1": None, "2": "A", "3": None}
    c = spark.createDataFrame([("NaN",), ("1.5",), ("-",)], "v string")
    assert [r.v for r in cov.coerce_numeric(c, ["v"]).collect()] == [None, 1.5, None]


def _orders(spark, *ids):
    return spark.createDataFrame([(i, None, "T", "PO", "OPEN") for i in ids], ORDER.schema)


def test_replace_may_read_what_it_replaces(spark, tmp):
    fs.publish(_orders(spark, "O1", "O2"), "inbound_order", tmp, "20240101_000000")
    with pytest.raises(ValueError):
        fs.publish(_orders(spark, "O3"), "inbound_order", tmp, "20240101_000000")
    own = fs.read_lake(spark, "inbound_order", tmp).drop("load_ts")
    fs.publish(own, "inbound_order", tmp, "20240102_000000", replace=True)
    back = fs.read_lake(spark, "inbound_order", tmp).collect()
    assert sorted(r.id for r in back) == ["O1", "O2"] and {r.load_ts for r in back} == {"20240102_000000"}


def test_a_failed_replace_keeps_the_old_load(spark, tmp):
    fs.publish(_orders(spark, "O1"), "inbound_order", tmp, "20240101_000000")
    bad = _orders(spark, "O2").withColumn("id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        fs.publish(bad, "inbound_order", tmp, "20240102_000000", replace=True)
    assert [r.id for r in fs.read_lake(spark, "inbound_order", tmp).collect()] == ["O1"]


def test_malformed_lake_value_is_an_error(spark, tmp):
    s = spec("inv_level")
    path = f"{tmp}/wa_inv_level/load_ts=20240101_000000"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write(",".join(s.columns) + "\n" + ",".join("notanumber" if c == "on_hand_inventory" else "" for c in s.columns) + "\n")
    with pytest.raises(Exception):
        fs.read_lake(spark, "inv_level", tmp).collect()


def _flow(spark, tmp, **kw):
    fl.run_flow(spark, flow_name="f", source_dir=f"{tmp}/src", schema=ORDER.schema, target_dir=f"{tmp}/tgt", checkpoint_dir=f"{tmp}/ck", log_dir=f"{tmp}/log", **kw)


def test_flow_refuses_another_header(spark, tmp):
    os.makedirs(f"{tmp}/src")
    with open(f"{tmp}/src/a.csv", "w") as f:
        f.write("tpartner_id,id,connection_id,order_type,order_status\nT1,O1,,PO,OPEN\n")
    with pytest.raises(Exception):
        _flow(spark, tmp)
    log = fl.read_log(spark, f"{tmp}/log").collect()
    assert [r.status for r in log] == ["FAILED"] and log[0].messages[0].message


def test_a_replayed_batch_loads_once(spark, tmp):
    import shutil
    fs.write_csv(_orders(spark, "O1", "O2"), f"{tmp}/src/load=1")
    _flow(spark, tmp)
    shutil.rmtree(f"{tmp}/ck/commits")  # as if the driver was lost after the write, before the commit
    _flow(spark, tmp)
    assert sorted(r.id for r in fl.read_loaded(spark, f"{tmp}/tgt").collect()) == ["O1", "O2"]
    assert fl.read_log(spark, f"{tmp}/log").count() == 1


def test_failed_flow_keeps_its_counts_and_whole_message(spark, tmp):
    fs.write_csv(_orders(spark, "O1", "O2"), f"{tmp}/src/load=1")
    with pytest.raises(Exception):
        _flow(spark, tmp, sql="SELECT raise_error(concat('{', repeat('x', 3000), id)) AS id FROM {source}")
    r = fl.read_log(spark, f"{tmp}/log").first()
    assert r.status == "FAILED" and r.records_processed == 2 and r.bytes_processed > 0 and len(r.messages[0].message) > 3000


def test_upsert_keeps_its_bucket_count_and_no_staging(spark, tmp):
    b = spark.createDataFrame([(f"K{i}", i) for i in range(10)], "id string, seq long")
    up.upsert_batch(b, 0, f"{tmp}/t", key=["id"], order=["seq"], buckets=4)
    with pytest.raises(ValueError):
        up.upsert_batch(b, 1, f"{tmp}/t", key=["id"], order=["seq"], buckets=8)
    assert up.read_target(spark, f"{tmp}/t").count() == 10
    assert not fs.path_exists(spark, f"{tmp}/t/_staging/batch=0")


def test_all_messages_of_failed_executions(spark):
    e = spark.sql("""SELECT 'f' AS flow_name, 1L AS execution_id, timestamp'2024-01-01' AS start_time, timestamp'2024-01-02' AS end_time,
                     'FAILED' AS status, 5L AS records_processed, 1L AS records_failed, 9L AS bytes_processed,
                     transform(sequence(1, 7), x -> named_struct('type', 'ERROR', 'message', string(x))) AS messages""")
    assert mo.failed_executions(e).count() == 7
    r = mo.failed_executions(e, 3).collect()
    assert len(r) == 3 and r[0].bytes_processed == 9 and r[0].end_time is not None


def test_scratch_needs_a_shared_folder_off_local_mode():
    from stockmap.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_validation_from_files(spark, tmp):
    from stockmap.operators import validate as va
    fs.publish(_orders(spark, "O1", "O1", None), "inbound_order", tmp, "20240101_000000")
    fs.publish(spark.createDataFrame([], spec("site").schema), "site", tmp, "20240101_000000")
    os.makedirs(f"{tmp}/wa_product/load_ts=20240101_000000")
    open(f"{tmp}/wa_product/load_ts=20240101_000000/x.csv", "w").close()  # a file without a header
    os.makedirs(f"{tmp}/wa_forecast")
    frames = va.open_datasets(spark, tmp)
    found = {(r.dataset, r.check): r.message for r in va.validate_all(spark, frames).collect()}
    assert found["product", "unreadable"] == found["forecast", "unreadable"] == found["company", "unreadable"] == "File not found"
    assert ("site", "empty") in found and found["inbound_order", "nulls"] == "Field 'id' has 1 null values"
    prof = {r.dataset: (r.rows, r.field_count, r.duplicate_keys) for r in va.dataset_profile(spark, frames).collect()}
    assert prof["inbound_order"] == (3, 5, 1) and prof["site"][0] == 0 and "product" not in prof


def test_append_mode_closes_windows_and_drops_late_rows(spark, tmp):
    import datetime as dt
    schema = "event_id long, ts timestamp, event_type string"

    def arrive(n, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(f"{tmp}/ev/p{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp}/ev")
        fl.run_to_table(fl.events_daily_stream(stream), f"{tmp}/ck", f"{tmp}/out", mode="append")

    arrive(0, (1, dt.datetime(2024, 1, 1, 5), "click"), (2, dt.datetime(2024, 1, 1, 6), "click"))
    arrive(1, (3, dt.datetime(2024, 1, 5), "click"))
    arrive(2, (4, dt.datetime(2024, 1, 1, 7), "click"), (5, dt.datetime(2024, 1, 9), "view"))  # the first is late by days
    got = {(str(r.day), r.event_type, r.events) for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert ("2024-01-01", "click", 2) in got and not any(d == "2024-01-01" and n != 2 for d, _, n in got)
