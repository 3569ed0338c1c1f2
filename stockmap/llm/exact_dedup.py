"""Exact dedup: an extendible-hash index on shared files.

Texts are equal when identical after lower-casing A-Z. The key of a text is a
64-bit hash of its normal form.

1. Entries (id, key, SHA-256, row number) are written to the shared folder,
   and chains (key, rows) counted from them.
2. Directory. Keys are uniform, so the leading bits of a key choose its slot.
   The directory starts with as many bits as fill buckets to capacity on
   average; a bucket with more chains than ``capacity`` doubles the directory
   and is split by the next bit, down to ``DOUBLINGS`` more bits. A bucket
   keeps the smallest depth that fits, so several slots can share one bucket.
   Chains are counted by distinct keys: a text with any number of copies is
   one chain, and copies never overfill a bucket. Beyond ``BUCKETS`` buckets
   the capacity grows instead, so the directory has a fixed greatest size.
3. Owner tasks. The directory gives each text its bucket, and the texts are
   dealt by bucket: a task owns the key ranges of its buckets. Copies of a hot
   text (at most ``HOT_KEYS`` keys can be hot) are counted where they are read
   first, so each reading task hands on one row for it.
4. An owner walks its chains. Those of more than one row are compared by bytes:
   equal texts become one link (bucket, key, SHA-256, rows), different texts
   under one key stay separate links. The links are the index, written by bucket.
5. Every row looks up its link by (key, SHA-256); links of hot texts are looked
   up in the reading task. One row of each group stays.

The row with the largest id stays. Defined cases: a null text equals an empty
one; null ids lose against any id; of repeated rows with the same id and text
exactly one stays; an empty table gives an empty result; further columns are
kept by ``drop_copies`` and ignored otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockmap.llm.common import lower_ascii, table, with_count
from stockmap.session import materialize

CAPACITY = 1_000
#: Buckets before doublings: the directory has at most ``BUCKETS << DOUBLINGS`` slots and can be broadcast.
BUCKETS = 1 << 14
DOUBLINGS = 4
#: A key is hot with more than this many rows and more than one in ``HOT_KEYS`` of all rows.
HOT_ROWS, HOT_KEYS = 64, 1 << 16


def directory(chains: DataFrame, n_chains: int, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """``(slots, depth)``: for each slot of the directory (``depth`` leading key bits) its bucket and local depth."""
    capacity = max(capacity, math.ceil(n_chains / BUCKETS))
    start = max(0, math.ceil(math.log2(max(n_chains, 1) / capacity)) if n_chains > capacity else 0)
    depth = start + DOUBLINGS
    slots = chains.groupBy(_slot(depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    local = F.lit(depth)
    for d in range(depth - 1, start - 1, -1):
        held = f"_held_{d}"
        slots = slots.withColumn(held, F.sum("n").over(Window.partitionBy(F.shiftright("slot", depth - d))))
        local = F.when(F.col(held) <= capacity, F.lit(d)).otherwise(local)
    slots = slots.withColumn("local_depth", local)
    first = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return slots.select("slot", first.alias("bucket"), "local_depth"), depth


def _slot(depth: int):
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``norm`` (the compared form) and ``key``."""
    d = docs.withColumn("norm", lower_ascii(F.coalesce(F.col("text"), F.lit(""))))
    return d.withColumn("key", F.xxhash64("norm"))


def owned_links(texts: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """The links of all chains of more than one row, from ``texts`` (key, norm, n), found by the owner of each bucket.

    The window and the grouping hold ``bucket``, so both work on the rows as they were dealt.
    """
    at = texts.withColumn("slot", _slot(depth)).join(F.broadcast(slots.select("slot", "bucket")), "slot")
    dealt = at.select("bucket", "key", "norm", "n").repartition("bucket").sortWithinPartitions("bucket", "key")
    chain = F.sum("n").over(Window.partitionBy("bucket", "key"))
    return (dealt.withColumn("rows", chain).filter("rows > 1").groupBy("bucket", "key", "norm").agg(F.sum("n").alias("group_size"))
            .select("bucket", "key", F.sha2("norm", 256).alias("text_sha256"), "group_size"))


def groups(docs: DataFrame, capacity: int = CAPACITY, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, key."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    entries, held = materialize(
        with_key(docs).select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256"))
        .withColumn("_uid", F.monotonically_increasing_id()), "dedup-entries", [F.count(F.lit(1)).alias("rows")])
    chains, seen = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "dedup-chains",
                               [F.count(F.lit(1)).alias("chains"), F.coalesce(F.max("n"), F.lit(0)).alias("longest")])
    slots, depth = directory(chains, seen["chains"], capacity)
    slots = materialize(slots, "dedup-directory")
    most = max(hot_rows, held["rows"] // HOT_KEYS)  # fewer than HOT_KEYS keys can have more rows
    texts = with_key(docs).select("key", "norm")
    if seen["longest"] > most:
        hot = F.broadcast(chains.filter(F.col("n") > most).select("key"))
        counted = texts.join(hot, "key").groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"))
        texts = texts.join(hot, "key", "left_anti").withColumn("n", F.lit(1).cast("long")).unionByName(counted)
    else:
        texts = texts.withColumn("n", F.lit(1).cast("long"))
    links = materialize(owned_links(texts, slots, depth), "dedup-index")
    # Bytes decide: two texts that share both hashes would come out as two links here, and stop the job.
    one = F.when(F.count(F.lit(1)) == 1, F.first("group_size")).otherwise(
        F.raise_error(F.lit("two texts share their SHA-256")).cast("long"))
    sizes = links.groupBy("key", "text_sha256").agg(one.alias("group_size"))
    heads = materialize(entries.groupBy("key", "text_sha256").agg(F.max(F.struct("doc_id", "_uid")).alias("head"))
                        .join(sizes, ["key", "text_sha256"]), "dedup-heads")
    large = heads.filter(F.col("group_size") > most).withColumnsRenamed({"head": "large_head", "group_size": "large_size"})
    found = entries.join(F.broadcast(large), ["key", "text_sha256"], "left")
    # Rows that have their link go on under a name of their own, which no link has: none of them meet.
    found = found.withColumn("look_up", F.when(F.col("large_head").isNull(), F.col("text_sha256")).otherwise(F.col("_uid").cast("string")))
    others = heads.filter(F.col("group_size") <= most).withColumnRenamed("text_sha256", "look_up")
    found = found.join(others, ["key", "look_up"], "left")
    head, size = F.coalesce("large_head", "head"), F.coalesce("large_size", "group_size")
    return found.select(
        "doc_id", F.when(head.isNull(), F.col("doc_id")).otherwise(head["doc_id"]).alias("keep_id"),
        F.coalesce(size, F.lit(1).cast("long")).alias("group_size"),
        (head.isNull() | (F.col("_uid") == head["_uid"])).alias("kept"), "text_sha256", "key")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = groups(docs)
    key = F.xxhash64(lower_ascii(F.coalesce(F.col("text"), F.lit(""))))
    return with_count(docs, key, found.select("doc_id", F.col("key").alias("tag"), F.col("kept").cast("int").alias("copies")))


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays for its text, the size of its group and its digest."""
    return groups(table(spark, sf_dir, "documents")).drop("key")
