"""Event batches over arriving records: the same batches however the records are cut, lost writers leave nothing."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stockmap.operators import conform as cf
from stockmap.sources import commits
from stockmap.streaming import batching as ba

TS = "20240101000000"
ORDER = ["record_key", "payload"]


def records(spark, n):
    """``n`` records of two datasets that are sent (two thirds in one) and some of one that is not."""
    kind = F.when(F.col("id") % 3 < 2, "inv_level").otherwise("site")
    kind = F.when(F.col("id") % 50 == 7, "shipment").otherwise(kind)
    return spark.range(n).select(kind.alias("dataset"), F.format_string("%06d", "id").alias("record_key"),
                                 F.format_string('{"id":%d}', "id").alias("payload"))


def rows(df):
    return sorted((r["dataset"], r["batch_no"], r["event_group_id"], r["event_type"], r["operation"], r["records"], r["data"]) for r in df.collect())


def test_split_arrivals_give_the_batches_of_one_run(spark, tmp):
    r = records(spark, 1000)
    want = rows(cf.event_batches(r, TS))
    for name, cuts in (("even", [0, 250, 500, 750, 1000]), ("uneven", [0, 3, 4, 333, 333, 999, 1000]), ("one", [0, 1000])):
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            part = r.where((F.col("record_key") >= f"{a:06d}") & (F.col("record_key") < f"{b:06d}"))
            assert ba.add_records(part, i, f"{tmp}/{name}", order=ORDER)
            assert not ba.add_records(part, i, f"{tmp}/{name}", order=ORDER)  # a replay after the commit
        got = ba.read_batches(spark, f"{tmp}/{name}", TS)
        assert rows(got) == want
        assert all(x["closed"] == (x["records"] == 100) for x in got.collect())
        assert len(os.listdir(f"{tmp}/{name}/open")) <= 2


@pytest.mark.parametrize("reread", [False, True])
def test_full_batches_are_not_written_in_between(spark, tmp, monkeypatch, reread):
    written, write = {}, ba.materialize

    def keep(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(ba, "materialize", keep)
    r = records(spark, 6000)
    for i, part in enumerate((r.where("record_key < '000777'"), r.where("record_key >= '000777'"))):
        assert ba.add_records(part, i, f"{tmp}/t", order=ORDER, reread=reread)
    got = ba.read_batches(spark, f"{tmp}/t", TS)
    assert rows(got) == rows(cf.event_batches(r, TS)) and got.count() == 60
    # At most the first and last batch of a dataset in each of eight tasks; it was all 53 of the last micro-batch.
    assert written["event-batches"].count() <= 32


def test_stream_resumes_with_the_open_batch(spark, tmp):
    r = records(spark, 700)
    for i, (a, b) in enumerate(((0, 150), (150, 151), (151, 700))):
        r.where((F.col("record_key") >= f"{a:06d}") & (F.col("record_key") < f"{b:06d}")).write.parquet(f"{tmp}/src/p{i}")
        stream = spark.readStream.schema(r.schema).option("recursiveFileLookup", True).parquet(f"{tmp}/src")
        for _ in range(2):  # the second run finds nothing new
            ba.batch_stream(stream, f"{tmp}/out", f"{tmp}/ckpt", order=ORDER, batch_size=64, timeout_s=120)
    assert rows(ba.read_batches(spark, f"{tmp}/out", TS)) == rows(cf.event_batches(r, TS, 64))


@pytest.mark.parametrize("step", ["commit", "_swap"])
def test_a_lost_micro_batch_leaves_nothing_and_its_replay_all(spark, tmp, monkeypatch, step):
    r = records(spark, 500)
    early, late = r.where("record_key < '000230'"), r.where("record_key >= '000230'")
    ba.add_records(early, 0, tmp, order=ORDER)
    before = rows(ba.read_batches(spark, tmp, TS))

    def lost(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            ba.add_records(late, 1, tmp, order=ORDER)
    assert rows(ba.read_batches(spark, tmp, TS)) == before
    assert ba.add_records(late, 1, tmp, order=ORDER)
    got = rows(ba.read_batches(spark, tmp, TS))
    assert got == rows(cf.event_batches(r, TS))
    assert sum(len(json.loads(x[-1])) for x in got) == 490  # each record once


def test_empty_micro_batches_other_sizes_and_no_target(spark, tmp):
    r = records(spark, 30)
    with pytest.raises(FileNotFoundError):
        ba.read_batches(spark, f"{tmp}/t", TS)
    ba.add_records(r.limit(0), 0, f"{tmp}/t", order=ORDER)
    assert rows(ba.read_batches(spark, f"{tmp}/t", TS)) == []
    ba.add_records(r, 1, f"{tmp}/t", order=ORDER)
    ba.add_records(r.limit(0), 2, f"{tmp}/t", order=ORDER)
    assert rows(ba.read_batches(spark, f"{tmp}/t", TS)) == rows(cf.event_batches(r, TS))
    with pytest.raises(ValueError, match="batches of 100"):
        ba.add_records(r, 3, f"{tmp}/t", order=ORDER, batch_size=10)
