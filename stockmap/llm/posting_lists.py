"""Approximate nearest neighbours by largest inner product over balanced posting lists.

1. Equal vectors become one; of its ids the ``TOP + 1`` smallest are enough,
   as ties go to smaller ids. A vector that fills a third of the table is one entry.
2. Inner products become distances: each vector gets one more component
   ``sqrt(M^2 - |x|^2)`` (``M``: the largest norm), queries get 0.
3. Lists. A sample of at most ``FIT_ROWS`` vectors is halved again and again
   at the median along the line between two means, so all lists hold the same
   number of sample rows; their means are the centroids (at most ``MOST_LISTS``).
4. Every vector is written to its nearest list and, if it lies near a
   boundary, to each list whose centroid is at most ``REPLICATE`` times as far,
   up to ``REPLICAS`` lists.
5. A query finds centroids by best-first search in their neighbour graph and
   prunes by distance ratio: lists at most ``PROBE`` times as far as the
   nearest, up to ``PROBES`` (or a share of all lists), in any case enough
   to hold ``TOP + 1`` vectors.
6. Lists and the queries that probe them meet in cells of at most about
   ``CELL_ROWS`` by ``CELL_QUERIES``; each cell returns its best per query.
   Scores are double-precision inner products of the original vectors.

Defined cases: vectors null, zero, with null or non-finite components or of
another length than most take no part, neither as query nor as candidate;
rows repeated with the same id and vector count once; with fewer candidates
all are returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockmap.llm.common import table
from stockmap.session import materialize

TOP = 20
EVERY = 20
FIT_ROWS, LIST_ROWS, MOST_LISTS = 20_000, 256, 2048
REPLICATE, REPLICAS = 1.08, 6
#: A query probes at most ``PROBES`` lists, or one in ``SHARE`` where there are many.
PROBE, PROBES, SHARE = 1.25, 48, 6
NEIGHBOURS = 24
CELL_ROWS, CELL_QUERIES = 4096, 1024


def balanced_means(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of ``lists`` groups of equal size (a power of two, or fewer where rows run out)."""
    rng, groups = np.random.default_rng(seed), [np.arange(len(x))]
    while len(groups) < lists and min(map(len, groups)) >= 2:
        halves = []
        for g in groups:
            p = x[g]
            a, b = p[rng.choice(len(g), 2, replace=False)]
            for _ in range(6):
                along = p @ (b - a)
                upper = along > np.median(along)
                if upper.all() or not upper.any():
                    break
                a, b = p[~upper].mean(axis=0), p[upper].mean(axis=0)
            order = np.argsort(p @ (b - a), kind="stable")
            halves += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
        groups = halves
    return np.stack([x[g].mean(axis=0) for g in groups])


@dataclass
class Lists:
    """Centroids, their neighbour graph, and how many vectors have each list as their nearest."""
    centroids: np.ndarray
    graph: np.ndarray
    entry: int
    longest: float
    sizes: np.ndarray

    def assign(self, x: np.ndarray) -> list[np.ndarray]:
        """For each row (with its further component) the lists it is written to, nearest first."""
        d = np.maximum((x * x).sum(1)[:, None] + (self.centroids ** 2).sum(1) - 2 * x @ self.centroids.T, 0)
        near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
        far = np.take_along_axis(d, near, 1)
        return [n[f <= REPLICATE ** 2 * f[0] + 1e-12] for n, f in zip(near, far, strict=True)]

    def probe(self, q: np.ndarray) -> list[int]:
        """Lists for one query, by best-first search in the graph and the distance ratio."""
        def far(i: np.ndarray) -> np.ndarray:
            return ((self.centroids[i] - q) ** 2).sum(axis=1)
        most = max(PROBES, len(self.centroids) // SHARE)
        width = 2 * most
        d0 = float(far(np.array([self.entry]))[0])
        seen, open_, best = {self.entry}, [(d0, self.entry)], [(-d0, self.entry)]
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= width and d > -best[0][0]:
                break
            new = np.array([j for j in self.graph[i].tolist() if j not in seen], np.int64)
            if not len(new):
                continue
            seen.update(new.tolist())
            for dj, j in zip(far(new).tolist(), new.tolist(), strict=True):
                if len(best) < width or dj < -best[0][0]:
                    heapq.heappush(open_, (dj, j))
                    heapq.heappush(best, (-dj, j))
                    if len(best) > width:
                        heapq.heappop(best)
        found = sorted((-d, j) for d, j in best)
        chosen, held = [], 0
        for d, j in found:
            if held > TOP and (len(chosen) >= most or d > PROBE ** 2 * found[0][0]):
                break
            chosen.append(j)
            held += int(self.sizes[j])
        if held <= TOP:  # short lists only: go on with all centroids by distance
            for j in np.argsort(far(np.arange(len(self.centroids))), kind="stable").tolist():
                if held > TOP:
                    break
                if j not in chosen:
                    chosen.append(j)
                    held += int(self.sizes[j])
        return chosen


def neighbour_graph(c: np.ndarray) -> np.ndarray:
    """The nearest other centroids of each, and a ring through all so that every centroid can be reached."""
    d = (c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :min(NEIGHBOURS, max(len(c) - 1, 1))]
    ring = (np.arange(len(c)) + 1) % len(c)
    return np.column_stack([near, ring, (np.arange(len(c)) - 1) % len(c)])


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1) if values else np.zeros((0, 0))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles as bytes), norm2 of the rows of ``vectors`` (vec_id, embedding) that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs, norms, dims = [], [], [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                if v is None or i is None or any(x is None for x in v):
                    continue
                a = np.array(v, "<f8") + 0.0  # no negative zero
                norm = float(a @ a)
                if np.isfinite(a).all() and a.any():
                    ids, vs, norms, dims = [*ids, i], [*vs, a.tobytes()], [*norms, norm], [*dims, len(a)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vs, pa.binary()), pa.array(norms, pa.float64()), pa.array(dims, pa.int32())],
                                             names=["vec_id", "v", "norm2", "dim"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, v binary, norm2 double, dim int")


def fit(distinct: DataFrame, n: int, longest: float) -> Lists | None:
    """Centroids from a bounded sample (the vectors with the smallest hashes)."""
    rows = distinct.select("v", "norm2").orderBy(F.xxhash64("v"), "v").limit(FIT_ROWS).toPandas()
    if not len(rows):
        return None
    x = _augmented(_matrix(rows["v"]), rows["norm2"].to_numpy(), longest)
    lists = int(min(MOST_LISTS, max(1, n // LIST_ROWS), max(1, len(x) // 8)))
    c = balanced_means(x, lists)
    middle = int(((c - c.mean(axis=0)) ** 2).sum(axis=1).argmin())
    return Lists(c, neighbour_graph(c), middle, longest, np.zeros(len(c), np.int64))


def _augmented(x: np.ndarray, norm2: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(longest - norm2, 0))])


def _write_lists(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("v"))
            found = sent.value.assign(_augmented(x, batch.column("norm2").to_numpy(), sent.value.longest))
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            first = np.concatenate([np.arange(len(f)) == 0 for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int32()), pa.array(first), batch.column("vid").take(take), batch.column("v").take(take)],
                                             names=["list", "nearest", "vid", "v"])
    return run


def _probe_lists(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.probe(np.r_[q, 0.0]) for q in _matrix(batch.column("v"))]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([j for f in found for j in f], pa.int32()), batch.column("vid").take(take), batch.column("v").take(take)],
                                             names=["list", "qid", "q"])
    return run


def _cell(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The best vectors of one cell for each of its queries."""
    out = {"qid": [], "vid": [], "score": []}
    if len(rows) and len(queries):
        x, q = _matrix(rows["v"]), _matrix(queries["q"])
        ids, rough = rows["vid"].to_numpy(), q @ x.T
        for i, qid in enumerate(queries["qid"]):
            best = np.arange(len(ids))
            if len(ids) > TOP + 1:
                # Keep ties of the last place: rounding must not decide here.
                edge = np.partition(rough[i], len(ids) - TOP - 1)[len(ids) - TOP - 1]
                best = np.flatnonzero(rough[i] >= edge - 1e-9 * max(1.0, abs(edge)))
            out["qid"] += [qid] * len(best)
            out["vid"] += ids[best].tolist()
            out["score"] += (x[best] * q[i]).sum(axis=1).tolist()
    return pd.DataFrame({"qid": pd.Series(out["qid"], dtype="int64"), "vid": pd.Series(out["vid"], dtype="int64"), "score": pd.Series(out["score"], dtype="float64")})


def nearest(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` (vec_id, embedding) whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors), "ann-rows")
    common = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max_by("dim", F.struct("n", "dim")).alias("dim")).first().dim
    rows = rows.filter(F.col("dim") == F.lit(common if common is not None else -1)).select("vec_id", "v", "norm2").distinct()
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= top + 1)
    distinct, seen = materialize(
        ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("norm2").alias("norm2"))
        .withColumn("vid", F.monotonically_increasing_id()), "ann-distinct", [F.count(F.lit(1)).alias("n"), F.max("norm2").alias("longest")])
    result = "query_id long, rank int, vec_id long, score double"
    index = fit(distinct, seen["n"], seen["longest"] or 0.0)
    if index is None:
        return spark.createDataFrame([], result)
    postings = materialize(distinct.select("vid", "v", "norm2").mapInArrow(_write_lists(spark.sparkContext.broadcast(index)), "list int, nearest boolean, vid long, v binary"), "ann-lists")
    # At most MOST_LISTS rows come back.
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count_if("nearest").alias("near"))
    for r in sizes.collect():
        index.sizes[r.list] = r.near
    asked = materialize(rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
                        .join(distinct.select("v", "vid"), "v").select("query_id", F.col("vid").alias("qid"), "v"), "ann-queries")
    probes = materialize(asked.select(F.col("qid").alias("vid"), "v").distinct().mapInArrow(
        _probe_lists(spark.sparkContext.broadcast(index)), "list int, qid long, q binary"), "ann-probes")
    plan = sizes.join(probes.groupBy("list").agg(F.count(F.lit(1)).alias("nq")), "list").select(
        "list", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("shards"), F.ceil(F.col("nq") / CELL_QUERIES).cast("int").alias("parts"))
    left = postings.join(plan, "list").select("list", F.pmod(F.xxhash64("vid"), "shards").cast("int").alias("shard"),
                                              F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vid", "v")
    right = probes.join(plan, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                                             F.pmod(F.xxhash64("qid"), "parts").cast("int").alias("part"), "qid", "q")
    cells = ["list", "shard", "part"]
    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInPandas(_cell, "qid long, vid long, score double")
    found = found.groupBy("qid", "vid").agg(F.max("score").alias("score"))
    place = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("first_id"))
    found = found.join(distinct.select("vid", "ids", F.col("ids")[0].alias("first_id")), "vid").withColumn("r", F.row_number().over(place)).filter(F.col("r") <= top + 1)
    by_id = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    found = found.select("qid", "score", F.explode("ids").alias("vec_id")).withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= top + 1)
    answers = asked.select("query_id", "qid").join(found.select("qid", "vec_id", "score"), "qid").filter("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector of ``embeddings`` among all others."""
    return nearest(table(spark, sf_dir, "embeddings"))
