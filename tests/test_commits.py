"""A writer is lost between any two steps: readers see the old or the new state, whole."""

import random

import pytest
from pyspark.sql import functions as F

from stockmap.schemas import spec
from stockmap.sources import commits
from stockmap.sources import files as fs
from stockmap.streaming import upsert as up

KW = dict(key=["id"], order=["seq"], buckets=4)


class Lost(BaseException):
    """The driver is gone."""


def lose_at(monkeypatch, module, name, after):
    """Lose the writer before ``name`` is done, or just after it."""
    real = getattr(module, name)

    def step(*a, **k):
        if after:
            real(*a, **k)
        raise Lost
    monkeypatch.setattr(module, name, step)


def changes(spark, rows):
    return spark.createDataFrame(rows, "id string, seq long, v string")


def table(spark, target):
    return {r.id: (r.seq, r.v) for r in up.read_target(spark, target).collect()}


def test_state_moves_in_one_step(spark, tmp):
    assert commits.current(spark, tmp) == commits.State(0, {})
    a = commits.commit(spark, tmp, commits.State(0, {}), {"x": "ä"})
    b = commits.commit(spark, tmp, a, {"x": 2, "before": commits.manifest_name(spark, tmp)})
    assert commits.current(spark, tmp) == b == commits.State(2, {"x": 2, "before": b.body["before"]})
    with pytest.raises(commits.ConcurrentCommit):
        commits.commit(spark, tmp, a, {"x": 3})
    assert commits.current(spark, tmp) == b
    assert [s.version for s in commits.kept(spark, tmp, 5)] == [2, 1]
    assert len([x for x in fs.child_names(spark, f"{tmp}/_state") if not x.startswith(".")]) == 3  # two manifests, the pointer


STEPS = [(up, "materialize", False), (up, "_read_buckets", True), (commits, "_write", False), (commits, "_write", True), (commits, "_swap", False),
         (commits, "_swap", True), (up, "expire", False), (up, "delete_path", False)]


@pytest.mark.parametrize("module,name,after", STEPS)
def test_upsert_lost_at_any_step(spark, tmp, monkeypatch, module, name, after):
    first = [(f"K{i}", 1, "a") for i in range(20)]
    second = [(f"K{i}", 2, "b") for i in range(0, 40, 2)]
    third = [("K1", 3, "c")]
    old = {i: (s, v) for i, s, v in first}
    new = {**old, **{i: (s, v) for i, s, v in second}}
    assert up.upsert_batch(changes(spark, first), 0, tmp, **KW)
    with monkeypatch.context() as m:
        lose_at(m, module, name, after)
        try:
            up.upsert_batch(changes(spark, second), 1, tmp, **KW)
        except Lost:
            pass
    done = table(spark, tmp) == new
    assert done or table(spark, tmp) == old
    assert done == (name in ("expire", "delete_path") or (name == "_swap" and after))
    assert up.upsert_batch(changes(spark, second), 1, tmp, **KW) != done  # the replay
    assert table(spark, tmp) == new
    assert up.upsert_batch(changes(spark, third), 2, tmp, **KW)
    assert table(spark, tmp) == {**new, "K1": (3, "c")}
    # Two versions of four buckets: what the lost batch left is gone as well.
    folders = [(w, b) for w in fs.child_names(spark, f"{tmp}/data") for b in fs.child_names(spark, f"{tmp}/data/{w}") if b.startswith("_bucket")]
    assert len(folders) <= 8


def test_a_reader_keeps_the_version_it_opened(spark, tmp):
    up.upsert_batch(changes(spark, [(f"K{i}", 1, "a") for i in range(50)]), 0, tmp, **KW)
    before = up.read_target(spark, tmp)
    up.upsert_batch(changes(spark, [(f"K{i}", 2, "b") for i in range(50)]), 1, tmp, **KW)
    assert {r.v for r in before.collect()} == {"a"} and before.count() == 50
    assert {r.v for r in up.read_target(spark, tmp).collect()} == {"b"}


def test_random_batches_equal_a_dictionary(spark, tmp):
    r, want = random.Random(5), {}
    for n in range(6):
        rows = [(f"K{r.randrange(30)}", r.randrange(100) * 10 + n, f"v{k}") for k in range(r.randrange(0, 25))]
        rows = list({(i, s): (i, s, v) for i, s, v in rows}.values())
        for i, s, v in rows:
            want[i] = max(want.get(i, (-1, "")), (s, v))
        assert up.upsert_batch(changes(spark, rows), n, tmp, **KW)
        assert not up.upsert_batch(changes(spark, [("K0", 10_000, "replayed")]), n, tmp, **KW)
    assert table(spark, tmp) == want


def test_a_fresh_checkpoint_is_another_stream(spark, tmp):
    for n in range(2):
        changes(spark, [("K1", n, f"v{n}")]).write.parquet(f"{tmp}/src{n}")
        stream = spark.readStream.schema("id string, seq long, v string").parquet(f"{tmp}/src{n}")
        for _ in range(2):
            up.upsert_stream(stream, f"{tmp}/t", f"{tmp}/ck{n}", **KW)
    assert table(spark, f"{tmp}/t") == {"K1": (1, "v1")}


ORDER = spec("inbound_order")


def orders(spark, *ids):
    return spark.createDataFrame([(i, None, "T", "PO", "OPEN") for i in ids], ORDER.schema)


def loads(spark, root):
    out: dict[str, list[str]] = {}
    for r in fs.read_lake(spark, "inbound_order", root).collect():
        out.setdefault(r.load_ts, []).append(r.id)
    return {k: sorted(v) for k, v in out.items()}


PUBLISH_STEPS = [(fs, "write_csv", False), (fs, "write_csv", True), (fs, "rename_path", False), (fs, "rename_path", True), (commits, "_write", True),
                 (commits, "_swap", False), (commits, "_swap", True), (commits, "kept", True)]


@pytest.mark.parametrize("ts", ["20240101_000000", "20240102_000000"])
@pytest.mark.parametrize("module,name,after", PUBLISH_STEPS)
def test_replace_lost_at_any_step(spark, tmp, monkeypatch, module, name, after, ts):
    fs.publish(orders(spark, "O1", "O2"), "inbound_order", tmp, "20240101_000000")
    with monkeypatch.context() as m:
        lose_at(m, module, name, after)
        with pytest.raises(Lost):
            fs.publish(orders(spark, "O3"), "inbound_order", tmp, ts, replace=True)
    done = name == "kept" or (name == "_swap" and after)
    assert loads(spark, tmp) == ({ts: ["O3"]} if done else {"20240101_000000": ["O1", "O2"]})
    assert {r.load_ts for r in fs.manifest(spark, tmp).collect()} == set(loads(spark, tmp))
    fs.publish(orders(spark, "O4"), "inbound_order", tmp, ts, replace=True)
    assert loads(spark, tmp) == {ts: ["O4"]}
    base = fs.dataset_dir(tmp, "inbound_order")
    assert len([x for x in fs.child_names(spark, base) if x.startswith("load_ts=")]) == 1


def test_replace_lost_while_deleting(spark, tmp, monkeypatch):
    for day in (1, 2, 3):
        fs.publish(orders(spark, f"O{day}"), "inbound_order", tmp, f"2024010{day}_000000")
    real, calls = fs.delete_path, []

    def second_is_lost(s, path):
        calls.append(path)
        if len(calls) == 3:
            raise Lost
        real(s, path)
    with monkeypatch.context() as m:
        m.setattr(fs, "delete_path", second_is_lost)
        with pytest.raises(Lost):
            fs.publish(orders(spark, "O9"), "inbound_order", tmp, "20240109_000000", replace=True)
    assert loads(spark, tmp) == {"20240109_000000": ["O9"]}
    assert [r.id for r in fs.read_lake(spark, "inbound_order", tmp, "latest").collect()] == ["O9"]


def test_an_append_that_was_lost_can_be_repeated(spark, tmp, monkeypatch):
    fs.publish(orders(spark, "O1"), "inbound_order", tmp, "20240101_000000")
    with monkeypatch.context() as m:
        lose_at(m, commits, "_swap", False)
        with pytest.raises(Lost):
            fs.publish(orders(spark, "O2"), "inbound_order", tmp, "20240102_000000")
    assert loads(spark, tmp) == {"20240101_000000": ["O1"]}
    fs.publish(orders(spark, "O2", "O3"), "inbound_order", tmp, "20240102_000000")
    assert loads(spark, tmp) == {"20240101_000000": ["O1"], "20240102_000000": ["O2", "O3"]}


def test_folders_that_were_never_published_to_are_read_whole(spark, tmp):
    base = fs.dataset_dir(tmp, "inbound_order")
    for day in (1, 2):
        fs.write_csv(orders(spark, f"O{day}"), f"{base}/load_ts=2024010{day}_000000")
    assert loads(spark, tmp) == {"20240101_000000": ["O1"], "20240102_000000": ["O2"]}
    fs.publish(orders(spark, "O3"), "inbound_order", tmp, "20240103_000000")
    assert set(loads(spark, tmp)) == {"20240101_000000", "20240102_000000", "20240103_000000"}
    one = fs.read_lake(spark, "inbound_order", tmp).where(F.col("load_ts") == "20240102_000000")
    assert [r.id for r in one.collect()] == ["O2"]
