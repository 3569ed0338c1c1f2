import hashlib
import zlib
from collections import defaultdict

import pytest

from stockmap.llm import exact_dedup as ex
from stockmap.llm import mix_sources as mx
from stockmap.llm import shuffle_shards as sh
from stockmap.llm.common import prefix_sums, with_count

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOCS = "doc_id long, text string, source string, size int, key string, kept string, tag string"


def frame(spark, rows):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, s, 7, "k", "x", "t") for i, t, s in rows], DOCS)


ROWS = [(1, "Abc É", "a"), (2, "aBC É", "a"), (3, "abc é", "b"), (4, None, None), (5, "", "b"), (5, "", "b"), (None, "abc É", "c"),
        (6, "x" * 100_000, "a"), (7, "x y", "a"), (7, "x y", "a"), (8, " \t\n", "c"), (9, "one two three", "c")]


def lowered(t):
    return (t or "").translate(str.maketrans(UP, LOW))


def test_groups_equal_brute_force(spark):
    found = ex.groups(frame(spark, ROWS), capacity=2).collect()
    by = defaultdict(list)
    for i, t, _ in ROWS:
        by[lowered(t)].append(i)
    want = sorted(((i, max((x for x in by[lowered(t)] if x is not None), default=None), len(by[lowered(t)]),
                    hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t, _ in ROWS), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == want
    assert sum(r.kept for r in found) == len(by)


def test_hot_texts_are_counted_where_they_are_read(spark):
    rows = [(i, "hot Text", "a") for i in range(300)] + [(1000 + i, f"t {i % 40}", "b") for i in range(100)] + ROWS
    by = defaultdict(list)
    for i, t, _ in rows:
        by[lowered(t)].append(i)
    want = sorted(((i, max((x for x in by[lowered(t)] if x is not None), default=None), len(by[lowered(t)])) for i, t, _ in rows), key=repr)
    for hot_rows in (1, 20, 10_000):
        found = ex.groups(frame(spark, rows), capacity=4, hot_rows=hot_rows).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == want
        assert sum(r.kept for r in found) == len(by)


def test_owners_compare_texts_under_one_key(spark):
    """Different texts with one key stay separate links of the chain, and one owner finds them all."""
    texts = spark.createDataFrame([(5, "a", 1), (5, "b", 1), (5, "a", 3), (-9, "c", 1), (77, "d", 2)], "key long, norm string, n long")
    slots, depth = ex.directory(texts.select("key").distinct(), 3, capacity=1)
    slots = spark.createDataFrame(slots.collect(), slots.schema)
    links = ex.owned_links(texts, slots, depth)
    found = {(r.key, r.text_sha256): (r.group_size, r.bucket) for r in links.collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {k: v[0] for k, v in found.items()} == {(5, digest("a")): 4, (5, digest("b")): 1, (77, digest("d")): 2}
    assert found[5, digest("a")][1] == found[5, digest("b")][1]
    plan = ex.owned_links(texts, slots, depth)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "hashpartitioning(bucket" in plan


def test_one_row_of_each_group_stays_with_its_columns(spark):
    d = frame(spark, ROWS)
    kept = ex.drop_copies(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 9]
    assert ex.drop_copies(d.limit(0)).count() == 0 and ex.groups(d.limit(0)).count() == 0


def test_directory_splits_full_buckets_only(spark):
    from pyspark.sql import functions as F
    keys = spark.range(4000).select(F.xxhash64("id").alias("key"))
    skewed = keys.unionAll(spark.range(3000).select(F.shiftrightunsigned(F.xxhash64("id"), 3).alias("key"))).distinct()
    slots, depth = ex.directory(skewed, skewed.count(), capacity=800)
    rows = slots.collect()
    assert {r.local_depth for r in rows} and max(r.local_depth for r in rows) <= depth
    held = skewed.withColumn("slot", ex._slot(depth)).join(slots, "slot").groupBy("bucket", "local_depth").count().collect()
    assert len({r["bucket"] for r in held}) == len(held) and sum(r["count"] for r in held) == skewed.count()
    assert all(r["count"] <= 800 or r["local_depth"] == depth for r in held)
    assert len({r["local_depth"] for r in held}) > 1


def targets(sizes):
    """Water filling by rounds, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
        open_ -= full
        left -= sum(out[s] for s in full)
    return out


def test_mix_meets_targets(spark):
    rows = [(k, " ".join(["w"] * (k % 37)), "abcdefg"[k % 7] if k % 11 else None) for k in range(1500)]
    rows += [(5000 + k, "w " * 50, "hot") for k in range(700)] + [(7, "w w", "a")] * 3 + [(None, "w w w", "a"), (9999, None, "z")]
    from pyspark.sql import functions as F
    d = frame(spark, rows).select("doc_id", "source", mx.word_count(F.col("text")).alias("size"))
    quality = spark.createDataFrame([(k, 2.0 if k % 2 else 0.5) for k in range(0, 1500, 3)], "doc_id long, weight double")
    out = mx.mix(d, quality).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for s, t in targets(dict(sizes)).items():
        assert target[s] == pytest.approx(t) and t - 1 < taken[s] <= t + 1e-6
    again = mx.mix(d.repartition(5), quality).collect()
    assert sorted((r.source or "", r.taken) for r in again) == sorted((r.source or "", r.taken) for r in out)
    assert mx.mix(d.limit(0), quality).count() == 0
    blank = mx.mix(d.filter("size = 0"), None).collect()
    assert blank and all(r.taken == 0 and r.target == 0 for r in blank)


def test_mix_documents_repeats_whole_rows(spark):
    d = frame(spark, [(k, "w " * (k % 9 + 1), "ab"[k % 2]) for k in range(300)] + [(3, "w w w w ", "b")] * 4 + [(400, None, "a")])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    out = mx.mix_documents(d, labels)
    rows = out.collect()
    assert out.columns == d.columns
    total = sum(len((t or "").split()) for t in (r.text for r in d.collect()))
    assert abs(sum(len(r.text.split()) for r in rows) - 1.5 * total) <= 20
    assert all(r.text for r in rows)


def test_quality_counts(spark):
    from pyspark.sql import functions as F
    # Three equal sources: a gets twice its size, b 1.67 times, c 0.83 times.
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.element_at(F.split(F.lit("a b c"), " "), (F.col("id") % 3 + 1).cast("int")).alias("source"), F.lit(10).cast("long").alias("size"))
    q = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 2.0).otherwise(0.5).alias("weight"))
    for source in "bc":
        got = {r[0]: r[1] for r in mx.mix(d, q).filter(F.col("source") == source).groupBy(F.col("doc_id") % 2).agg(F.sum("taken")).collect()}
        assert got[0] > 1.1 * got[1]


def test_prefix_sums_over_many_partitions(spark):
    from pyspark.sql import functions as F
    d = spark.range(3000).select((F.col("id") % 5).alias("g"), (F.col("id") * 7919 % 3001).alias("o"), (F.col("id") % 13).alias("v"))
    rows = sorted((r.g, r.o, r.v, r.p) for r in prefix_sums(d, ["o"], "v", "p", group="g").collect())
    run = defaultdict(int)
    for g, _, v, p in rows:
        assert p == run[g]
        run[g] += v


@pytest.mark.parametrize("n", [1, 2, 3, 23, 24, 25, 500])
def test_shards_are_the_computed_permutation(spark, n):
    from pyspark.sql import functions as F
    d = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(9).cast("long").alias("size"))
    rows = sorted(sh.feistel_shards(d, ["doc_id"]).collect())
    places = [sh.permute(i, n) for i in range(n)]
    assert sorted(places) == list(range(n))
    assert [(r.shard, r.slot) for r in rows] == [(p % 24, p // 24) for p in places]


def test_shard_query_columns_ties_and_nulls(spark, tmp):
    frame(spark, ROWS).write.parquet(f"{tmp}/documents.parquet")
    rows = sh.op9_feistel_shards(spark, tmp).collect()
    assert len(rows) == len(ROWS) and {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        (i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, ())) for k in range(24)]
    assert max(counts) - min(counts) <= 1
    frame(spark, []).write.parquet(f"{tmp}/none/documents.parquet")
    assert sh.op9_feistel_shards(spark, f"{tmp}/none").count() == 0


def test_with_count_shares_copies_of_repeated_rows(spark):
    from stockmap.llm.common import text_tag
    from pyspark.sql import functions as F
    d = spark.createDataFrame([(1, "a", "p"), (1, "a", "q"), (2, "b", "p"), (None, "c", "p")], "doc_id long, text string, tag string")
    counted = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (2, "b", 0), (None, "c", 3)], "doc_id long, text string, copies int").select(
        "doc_id", text_tag(F.col("text")).alias("tag"), "copies")
    out = with_count(d, text_tag(F.col("text")), counted).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, "c")] * 3 + [(1, "a")] * 3
