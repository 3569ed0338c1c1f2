"""Files with differing headers, kept rejects, and runs that are still going."""

import json
import os

import pytest

from stockmap.schemas import spec
from stockmap.sources import files as fs
from stockmap.streaming import flows as fl

ORDER = spec("inbound_order")
HEAD = "id,connection_id,tpartner_id,order_type,order_status\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_files_with_swapped_columns_go_by_name(spark, tmp):
    a = [["NAME", "POP", "zip"], ["a, b", "1", "98001"], ["[c]", None, "98002"]]
    b = [["zip", "NAME", "EXTRA"], ["99001", "d", "x"], ["99002"]]
    want = {("98001", "a, b", "1", None), ("98002", "[c]", None, None), ("99001", "d", None, "x"), ("99002", None, None, None)}
    for n, m in enumerate((a, b)):
        put(f"{tmp}/lines/{n}.json", "[" + ",\n".join(json.dumps(r) for r in m) + "]\n")
        put(f"{tmp}/one/{n}.json", json.dumps(m))
        put(f"{tmp}/many/{n}.json", json.dumps(m, indent=1))
    for df in (fs.read_json_matrix(spark, f"{tmp}/lines"), fs.read_json_matrix(spark, f"{tmp}/one", whole=True), fs.read_json_matrix(spark, f"{tmp}/many", whole=True)):
        assert set(df.columns) == {"NAME", "POP", "zip", "EXTRA"}
        assert {(r.zip, r.NAME, r.POP, r.EXTRA) for r in df.collect()} == want and df.count() == 4


def test_a_matrix_without_a_header_or_form_is_an_error(spark, tmp):
    put(f"{tmp}/a/x.json", '["1","2"],\n')
    with pytest.raises(ValueError):
        fs.read_json_matrix(spark, f"{tmp}/a")
    put(f"{tmp}/b/1.json", '[["p","q"],\n["1","2"]]')
    put(f"{tmp}/b/2.json", '[["q","p"],\n["1","2"]]')
    put(f"{tmp}/b/3.json", '["5","6"],\n')  # whose columns?
    with pytest.raises(Exception, match="no header row"):
        fs.read_json_matrix(spark, f"{tmp}/b").collect()
    put(f"{tmp}/c/1.json", '{"no": "matrix"}')
    with pytest.raises(Exception):
        fs.read_json_matrix(spark, f"{tmp}/c", whole=True).collect()


def flow(spark, tmp, schema=ORDER.schema, **kw):
    fl.run_flow(spark, flow_name="f", source_dir=f"{tmp}/src", schema=schema, target_dir=f"{tmp}/tgt", checkpoint_dir=f"{tmp}/ck", log_dir=f"{tmp}/log",
                rejects_dir=f"{tmp}/rej", **kw)


def test_rejects_are_kept_with_their_reason(spark, tmp):
    schema = "id string, n int, d date"
    from pyspark.sql.types import _parse_datatype_string
    put(f"{tmp}/src/a.csv", "id,n,d\nA,1,2024-01-01\nB,x,2024-01-01\nC,2,never\nD,y,never\nE,3\n")
    flow(spark, tmp, _parse_datatype_string(schema))
    put(f"{tmp}/src/b.csv", "id,n,d\nF,1,2024-01-01\n\"G,1\",z,2024-01-01\n")
    flow(spark, tmp, _parse_datatype_string(schema))
    got = {r.record: r.reason for r in fl.read_rejects(spark, f"{tmp}/rej").collect()}
    assert got == {"B,x,2024-01-01": "value does not fit: n", "C,2,never": "value does not fit: d", "D,y,never": "value does not fit: n, d", "E,3": "wrong number of fields",
                   '"G,1",z,2024-01-01': "value does not fit: n"}
    log = fl.read_log(spark, f"{tmp}/log").collect()
    assert sorted(r.records_failed for r in log) == [1, 4] and sum(r.records_failed for r in log) == len(got)
    assert {os.path.basename(r.file) for r in fl.read_rejects(spark, f"{tmp}/rej").collect()} == {"a.csv", "b.csv"}
    assert sorted(r.id for r in fl.read_loaded(spark, f"{tmp}/tgt").collect()) == ["A", "F"]


def test_a_lost_run_stays_running_until_it_is_replayed(spark, tmp, monkeypatch):
    put(f"{tmp}/src/a.csv", HEAD + "O1,,T,PO,OPEN\n")
    real = fl._log

    def lost(session, path, row):
        if path.endswith(f"_phase={fl._LAST}"):
            raise RuntimeError("the driver is gone")
        real(session, path, row)
    with monkeypatch.context() as m:
        m.setattr(fl, "_log", lost)
        with pytest.raises(Exception):
            flow(spark, tmp)
    row = fl.read_log(spark, f"{tmp}/log").first()
    assert (row.status, row.end_time, row.execution_id) == ("RUNNING", None, "f-0")
    from stockmap.operators import monitor as mo
    stats = mo.execution_stats(spark.createDataFrame([("f",), ("g",)], "flow_name string"), fl.read_log(spark, f"{tmp}/log")).first()
    assert (stats.running, stats.succeeded, stats.total_executions) == (1, 0, 1)
    flow(spark, tmp)
    log = fl.read_log(spark, f"{tmp}/log").collect()
    assert [r.status for r in log] == ["SUCCEEDED"] and log[0].end_time is not None
    assert [r.id for r in fl.read_loaded(spark, f"{tmp}/tgt").collect()] == ["O1"]
