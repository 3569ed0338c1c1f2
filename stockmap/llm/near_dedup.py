"""MinHash near-dedup with b-bit signatures and exact links.

The set of a document is its distinct word shingles as 64-bit hashes. Two
documents are linked if ``100 * intersection >= 80 * union``.

1. ``sketch``: one pass gives each document the digest of its set, the keys of
   ``BANDS`` bands of ``ROWS`` minima each, and the low ``BITS`` bits of all
   minima packed into a signature. At a similarity of 0.8 a pair shares no
   band with a chance of (1 - 0.8^5)^32 = 3e-6.
2. Equal sets become one class before anything else; copies cost nothing further.
3. Classes that share a band key are candidates. Never are all pairs of a
   bucket written: each class meets one pivot of each of its buckets.
   Pivots are first in one of ``ORDERS`` random orders, which the key chooses,
   so a class in a large group meets several different ones.
4. A pair is estimated by the bit count of equal signature fields, corrected
   for chance hits: ``s = (m - 2^-b) / (1 - 2^-b)``; below ``PRUNE`` (five
   standard errors under 0.8) it is dropped, others are confirmed on full sets.
5. What stays open are buckets that hold several components. They form
   clusters; in each, all classes outside the largest component are compared
   with all others of the cluster in cells of bounded size (blocks against
   blocks, each cell one small group), and only links found leave a cell. So
   no link between different texts is lost, and no bucket is capped.

The result is one row for each document; ``component_id`` is the smallest
document id reachable over links. Defined cases: null and empty texts have the
empty set, are linked with nothing and stay; a text of fewer words than a
shingle is one shingle; of repeated rows one stays; null ids are larger than
all others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import distinct_sorted, table, text_tag, with_count
from stockmap.llm.components import components
from stockmap.session import materialize

THRESHOLD = 80
BANDS, ROWS, BITS = 32, 5, 4
HASHES = BANDS * ROWS
PRUNE = 0.635
ORDERS = 4
#: Shingles on either side of a cell, on average at most.
CELL = 1 << 17

_M = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit constants."""
    out = []
    for _ in range(n):
        seed = (seed + 0x9E3779B97F4A7C15) & _M
        z = (seed ^ seed >> 30) * 0xBF58476D1CE4E5B9 & _M
        z = (z ^ z >> 27) * 0x94D049BB133111EB & _M
        out.append((z ^ z >> 31) | 1)
    return np.array(out, np.uint64)


_A = _splitmix(HASHES, 1)[:, None]
_MIX = _splitmix(4, 2)
_BAND = _splitmix(BANDS, 3)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct shingles of ``width`` words as rising 64-bit hashes; A-Z lower-cased, words between white space."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    width = min(width, len(h))
    s = h[:len(h) - width + 1] * _MIX[0]
    for k in range(1, width):
        s = (s ^ s >> np.uint64(31)) * _MIX[1] + h[k:len(h) - width + 1 + k] * _MIX[2]
    s = (s ^ s >> np.uint64(29)) * _MIX[3]
    return distinct_sorted(s ^ s >> np.uint64(32))


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, _M, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            np.minimum(low, (_A * shingles[at:at + 512]).min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows, key = low.reshape(BANDS, ROWS), _BAND.copy()
        for j in range(ROWS):
            key = (key ^ rows[:, j]) * _MIX[1]
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def pack(low: np.ndarray) -> bytes:
    """Two 4-bit fields in a byte."""
    v = (low & np.uint64(15)).astype(np.uint8)
    return (v[::2] | v[1::2] << 4).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of signatures (``uint64`` rows; broadcast), corrected for fields that agree by chance."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=-1, dtype=np.int64)
    m, chance = 1 - differ / HASHES, 2.0 ** -BITS
    return (m - chance) / (1 - chance)


def linked(common: int | np.ndarray, n_a: int | np.ndarray, n_b: int | np.ndarray) -> bool | np.ndarray:
    return 100 * common >= THRESHOLD * (n_a + n_b - common)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8", copy=False).data, digest_size=16).digest()


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, tag, n_shingles, set_id, bands, signature of each row of ``docs``; the last three null for the empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), width)
                low = minima(s) if len(s) else None
                rows.append((len(s), _digest(s), band_keys(low), pack(low)) if len(s) else (0, None, None, None))
            n, ids, bands, sigs = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sigs, pa.binary())], names=["doc_id", "tag", "n_shingles", "set_id", "bands", "signature"])

    return docs.select("doc_id", text_tag(F.col("text")).alias("tag"), "text").mapInArrow(
        run, "doc_id long, tag long, n_shingles long, set_id binary, bands array<long>, signature binary")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), width) for t in batch.column("text")]
            # An id may occur with several texts; only the one of this class counts.
            own = [i for i, (s, d) in enumerate(zip(found, batch.column("set_id").to_pylist(), strict=True)) if len(s) and _digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(own, pa.int64())) for c in ("cls", "signature")),
                 pa.array([found[i].astype("<u8", copy=False).tobytes() for i in own], pa.binary())], names=["cls", "signature", "shingles"])
    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {c: batch.column(c) for c in batch.schema.names}
        sig = [np.frombuffer(b"".join(col[c].to_pylist()), np.uint64).reshape(len(batch), -1) for c in ("sig_a", "sig_b")]
        hit = []
        for i in np.flatnonzero(estimate(*sig) >= PRUNE) if len(batch) else ():
            x, y = (np.frombuffer(col[c][int(i)].as_py(), "<u8") for c in ("set_a", "set_b"))
            if linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                hit.append(int(i))
        take = pa.array(hit, pa.int64())
        yield pa.RecordBatch.from_arrays([col["a"].take(take), col["b"].take(take)], names=["a", "b"])


def _cell_links(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links of one cell; rows: (cls, root, side, signature, shingles). One link for each class and other component."""
    xs, ys = ([r for r in rows if r[2] == side] for side in (0, 1))
    if not xs or not ys:
        return []
    flat = np.concatenate([np.frombuffer(r[4], "<u8") for r in ys])
    size = np.array([len(r[4]) // 8 for r in ys])
    start = np.cumsum(size) - size
    values, code = np.unique(flat, return_inverse=True)
    sig = np.stack([np.frombuffer(r[3], np.uint64) for r in ys])
    root, out = np.array([r[1] for r in ys]), []
    for cls, own, _, own_sig, own_set in xs:
        near = np.flatnonzero((estimate(np.frombuffer(own_sig, np.uint64)[None, :], sig) >= PRUNE) & (root != own))
        if not len(near):
            continue
        s = np.frombuffer(own_set, "<u8")
        at = np.searchsorted(values, s)
        at[at == len(values)] = 0
        marks = np.zeros(len(values), np.int64)
        marks[at[values[at] == s]] = 1
        done: set[int] = set()
        for j in near:
            if int(root[j]) not in done and linked(int(marks[code[start[j]:start[j] + size[j]]].sum()), len(s), int(size[j])):
                done.add(int(root[j]))
                out.append((cls, ys[j][0]))
    return out


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell; a cell may go over several batches."""
    cell, rows = None, []
    for batch in batches:
        found: list[tuple[int, int]] = []
        for key, *row in zip(*(batch.column(c).to_pylist() for c in ("cell", "cls", "root", "side", "signature", "shingles")), strict=True):
            if key != cell:
                found += _cell_links(rows)
                cell, rows = key, []
            rows.append(tuple(row))
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    a, b = zip(*found, strict=True) if (found := _cell_links(rows)) else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _with_root(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots.withColumnsRenamed({"node": "cls"}), "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def _star(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between each class and one pivot of each of its buckets."""
    order = F.xxhash64("cls", F.pmod("key", F.lit(ORDERS)))
    pivots = members.groupBy("key").agg(F.min_by("cls", order).alias("pivot"))
    pairs = members.join(pivots, "key").filter("cls <> pivot").select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct()
    side = [sets.select(F.col("cls").alias(x), F.col("signature").alias(f"sig_{x}"), F.col("shingles").alias(f"set_{x}")) for x in "ab"]
    return pairs.join(side[0], "a").join(side[1], "b").mapInArrow(_confirm, "a long, b long")


def _remainder(members: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between components that share a bucket: the exact way for what the stars leave open."""
    m = _with_root(members, roots)
    open_ = m.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    part = materialize(m.join(open_, "key").select("cls", "root", F.col("r0")).distinct(), "near-open")
    joined = components(part.select(F.col("root").alias("a"), F.col("r0").alias("b")), name="near-clusters")
    part = part.select("cls", "root").distinct().join(joined.select(F.col("node").alias("root"), F.col("root").alias("cluster")), "root", "left") \
        .withColumn("cluster", F.coalesce("cluster", "root"))
    sized = materialize(part.join(sets.select("cls", (F.octet_length("shingles") / 8).cast("long").alias("n")), "cls"), "near-parts")
    by_root = sized.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    clusters = by_root.groupBy("cluster").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("c"), F.sum("s").alias("all"),
                                              F.max("c").alias("main_c")).filter("c > 2")
    sides = sized.join(clusters, "cluster")
    minor = F.col("root") != F.col("main")
    blocks_y = F.ceil(F.col("all") / CELL).cast("int")
    # Classes of the largest component are no more than all: as many blocks serve for the others, most of them small.
    share = F.ceil(F.col("all") * (1 - F.col("main_c") / F.col("c")) / CELL).cast("int")
    blocks_x = F.greatest(F.lit(1), share)
    own = F.pmod(F.xxhash64("cls"), F.lit(1 << 30)).cast("int")
    x = sides.filter(minor).select("cls", "root", F.lit(0).alias("side"), "cluster", (own % blocks_x).alias("i"),
                                   F.explode(F.sequence(F.lit(0), blocks_y - 1)).alias("j"))
    y = sides.select("cls", "root", F.lit(1).alias("side"), "cluster", F.explode(F.sequence(F.lit(0), blocks_x - 1)).alias("i"), (own % blocks_y).alias("j"))
    cells = x.unionAll(y).withColumn("cell", F.concat_ws(":", "cluster", "i", "j")).join(sets, "cls")
    cells = cells.select("cell", "cls", "root", "side", "signature", "shingles").repartition("cell").sortWithinPartitions("cell", "side", "cls")
    return cells.mapInArrow(_cells, "a long, b long")


def near_groups(docs: DataFrame, width: int) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, tag."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialize(sketch(docs, width).withColumn("uid", F.monotonically_increasing_id()), "near-rows")
    classes = materialize(
        rows.filter("set_id is not null").groupBy("set_id").agg(
            F.min("uid").alias("cls"), F.min("doc_id").alias("min_doc"), F.min_by("uid", "doc_id").alias("min_uid"),
            F.min_by("tag", F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("tag"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        .withColumn("min_uid", F.coalesce("min_uid", "cls")), "near-classes")
    banded = classes.select("cls", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    members = materialize(banded.join(shared, "key"), "near-members")
    wanted = members.select("cls").distinct().join(classes.select("cls", "set_id", "min_doc", "tag", "signature"), "cls")
    # By id and text: ids alone may be null or repeat in very many rows.
    same = docs.doc_id.eqNullSafe(wanted.min_doc) & (text_tag(docs.text) == wanted.tag)
    texts = docs.join(wanted.hint("merge"), same).select("cls", "set_id", "signature", "text").distinct()
    sets = materialize(texts.mapInArrow(_sets(width), "cls long, signature binary, shingles binary"), "near-sets")
    roots = components(_star(members, sets), name="near-components")
    more = _remainder(members, sets, roots)
    links = more.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = components(links, name="near-final")
    named = classes.select("set_id", "cls", "min_doc", "min_uid").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    best = named.groupBy("root").agg(F.min("min_doc").alias("component_id"), F.coalesce(F.min_by("min_uid", "min_doc"), F.min("min_uid")).alias("first_uid"))
    by_set = materialize(named.join(best, "root").select("set_id", "component_id", "first_uid"), "near-sets-found")
    out = rows.select("uid", "doc_id", "n_shingles", "set_id", "tag").join(by_set, "set_id", "left")
    empty = F.col("set_id").isNull()
    return out.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (empty | (F.col("uid") == F.col("first_uid"))).alias("kept"), "tag")


def drop_near(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay (one for each component), with all their columns."""
    found = near_groups(docs, width)
    return with_count(docs, text_tag(F.col("text")), found.select("doc_id", "tag", F.col("kept").cast("int").alias("copies")))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of ``documents`` under links of two-word shingle sets at a similarity of 0.8."""
    return near_groups(table(spark, sf_dir, "documents"), width=2).drop("tag")
