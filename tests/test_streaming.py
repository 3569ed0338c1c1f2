import datetime as dt

from pyspark.sql import functions as F

from stockmap.operators import conform as cf
from stockmap.schemas import spec
from stockmap.sources import files as fs
from stockmap.streaming import flows as fl
from stockmap.streaming import upsert as up

SCHEMA = "id string, event_ts timestamp, seq long, status string"


def test_incremental_flow_loads_new_files_once(spark, tmp):
    s = spec("inbound_order")
    a = spark.createDataFrame([("O1", None, "T1", "PO", "OPEN")], s.schema)
    b = spark.createDataFrame([("O2", None, "T2", "PO", "OPEN"), ("O3", None, "T3", "PO", "OPEN")], s.schema)
    kw = dict(flow_name="f", source_dir=f"{tmp}/src", schema=s.schema, target_dir=f"{tmp}/tgt",
              checkpoint_dir=f"{tmp}/ck", log_dir=f"{tmp}/log")
    fs.write_csv(a, f"{tmp}/src/load=1")
    fl.run_flow(spark, **kw)
    fs.write_csv(b, f"{tmp}/src/load=2")
    fl.run_flow(spark, **kw)
    fl.run_flow(spark, **kw)
    assert sorted(r.id for r in fl.read_loaded(spark, f"{tmp}/tgt").collect()) == ["O1", "O2", "O3"]
    log = fl.read_log(spark, f"{tmp}/log").orderBy("execution_id").collect()
    assert [r.records_processed for r in log] == [1, 2]


def test_flow_counts_corrupt_rows(spark, tmp):
    import os
    os.makedirs(f"{tmp}/src", exist_ok=True)
    with open(f"{tmp}/src/part-0.csv", "w") as f:
        f.write("id,connection_id,tpartner_id,order_type,order_status\nO1,,T1,PO,OPEN\n\"broken,row\n")
    s = spec("inbound_order")
    fl.run_flow(spark, flow_name="f", source_dir=f"{tmp}/src", schema=s.schema, target_dir=f"{tmp}/tgt",
                checkpoint_dir=f"{tmp}/ck", log_dir=f"{tmp}/log")
    r = fl.read_log(spark, f"{tmp}/log").first()
    assert r.records_failed >= 1 and r.status == "SUCCEEDED"


def test_upsert_latest_wins_and_replay_is_idempotent(spark, tmp):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    b0 = spark.createDataFrame([("K1", t2, 2, "new"), ("K2", t1, 1, "x")], SCHEMA)
    b1 = spark.createDataFrame([("K1", t1, 1, "old"), ("K3", t1, 1, "y")], SCHEMA)
    tgt = f"{tmp}/t"
    assert up.upsert_batch(b0, 0, tgt, key=["id"], order=["event_ts", "seq"], buckets=4)
    assert up.upsert_batch(b1, 1, tgt, key=["id"], order=["event_ts", "seq"], buckets=4)
    assert not up.upsert_batch(b1, 1, tgt, key=["id"], order=["event_ts", "seq"], buckets=4)  # replay
    got = {r.id: r.status for r in up.read_target(spark, tgt).collect()}
    assert got == {"K1": "new", "K2": "x", "K3": "y"}


def test_batches_hold_at_most_100(spark):
    df = spark.range(0, 250).select(F.lit("site").alias("dataset"),
                                    F.format_string("%05d", "id").alias("record_key"),
                                    F.to_json(F.struct(F.col("id"))).alias("payload"))
    b = cf.event_batches(df, "20240101000000").orderBy("batch_no").collect()
    assert [r.records for r in b] == [100, 100, 50]
    assert b[0].event_type == "scn.data.dataset" and b[0].operation == "UPSERT"
    assert b[0].data.startswith('[{"id":0},{"id":1}')


def test_batches_across_many_tasks_and_without_rejects(spark):
    import json
    sites = spark.range(0, 3001).repartition(13).select(F.lit("site").alias("dataset"), F.format_string("%05d", "id").alias("record_key"), F.to_json(F.struct("id")).alias("payload"))
    more = spark.range(0, 100).select(F.lit("inv_level").alias("dataset"), F.format_string("%05d", "id").alias("record_key"), F.to_json(F.struct("id")).alias("payload"))
    rejected = more.withColumn("dataset", F.lit("forecast"))
    rows = cf.event_batches(sites.unionByName(more).unionByName(rejected), "20240101000000").collect()
    assert {r.dataset for r in rows} == {"site", "inv_level"}
    by = {(r.dataset, r.batch_no): [x["id"] for x in json.loads(r.data)] for r in rows}
    assert len(by) == len(rows) == 32
    for k in range(31):
        assert by["site", k + 1] == list(range(100 * k, min(3001, 100 * k + 100)))
    assert by["inv_level", 1] == list(range(100))


def test_daily_windows_stream(spark, tmp):
    rows = [(1, dt.datetime(2024, 1, 1, 5), "click"), (2, dt.datetime(2024, 1, 1, 9), "click"),
            (3, dt.datetime(2024, 1, 2, 1), "view")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string").write.parquet(f"{tmp}/ev")
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string").parquet(f"{tmp}/ev")
    fl.run_to_table(fl.events_daily_stream(stream), f"{tmp}/ck", f"{tmp}/out")
    got = sorted((str(r.day), r.event_type, r.events) for r in spark.read.parquet(f"{tmp}/out").collect())
    assert got == [("2024-01-01", "click", 2), ("2024-01-02", "view", 1)]


def test_routing_splits_rejects(spark):
    df = spark.createDataFrame([("inv_level", "a"), ("site", "b"), ("forecast", "c"), ("shipment", "d")],
                               "dataset string, record_key string")
    ok, rej = cf.split_routed(df)
    got = {r.dataset: (r.event_type, r.operation) for r in ok.collect()}
    assert got == {"inv_level": ("scn.data.inventorylevel", None), "site": ("scn.data.dataset", "UPSERT")}
    assert sorted(r.dataset for r in rej.collect()) == ["forecast", "shipment"]
