"""Ranked lexical search by dense blocked multiplication.

Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased. With ``N`` documents that hold a term, ``L`` their terms, ``n``
those of one document, ``df`` the documents that hold a term and ``tf`` its
occurrences in one:

    w = floor(1000 ln((2 N + 2) / (2 df + 1))),   m = 25 + (75 n N) div L,
    impact = w * ((10^9 tf) div (1000 tf + 8 m)),   score = sum over an item's terms.

1. Items are cut into groups by running sums of their distinct terms
   (``GROUP_TERMS``), so what is broadcast is bounded however many items there
   are; a group of one item holds the terms of one text.
2. One pass over all whole texts counts each document's terms and keeps the
   numbers and occurrences of those in the group's vocabulary, as packed
   arrays in a written table. Sums over it give ``N``, ``L`` and ``df``.
3. A group is cut into tiles of ``TILE_ITEMS`` items. A tile has a compact
   vocabulary of its own, cut so that the partial score of any item within one
   part stays below 2^53: every product and sum of doubles is a whole number
   without rounding. Parts are added as 64-bit whole numbers.
4. Documents come in blocks of ``BLOCK``. A block's impacts are spread into a
   dense (terms x documents) tile, the item tile is a dense (items x terms)
   one, and one matrix product scores all its items against all documents.
5. Each task keeps the best ``TOP`` of every item under the order (score
   falling, id rising): a block's ties at the last place all stay in until ids
   have decided. The tasks' lists meet by item in a window with a limit.

Defined cases: null and empty texts have no terms, count nowhere and are never
found; repeated rows are documents of their own (the same id may come twice),
a null id comes after all others of its score; repeated item rows of equal id
and text are one item, equal ids with different texts are items of their own;
an item without terms or hits gives no rows; empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockmap.llm.common import prefix_sums, table
from stockmap.session import materialize

TOP = 10
#: Distinct (item, term) pairs of one group of items: some 100 MB at most in a task.
GROUP_TERMS = 1 << 20
TILE_ITEMS, TILE_TERMS, BLOCK = 256, 4096, 1024
EXACT = 1 << 53
#: No quotient of an impact reaches this.
MOST_QUOTIENT = 1_000_000

#: A-Z to a-z; ASCII that is neither letter nor digit to blanks; all else as it is.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def quotients(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


@dataclass
class Tile:
    """Items by number, and the parts of their vocabulary: term numbers, dense (items x terms) weights."""
    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def make_tiles(owner: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, items: int) -> list[Tile]:
    """Tiles of the triples (item number, term number, occurrences), sorted by item; ``weight``: w of each term number.

    The dense weights are occurrences x w. A part ends before any item's
    largest possible partial score would reach 2^53.
    """
    tiles = []
    for first in range(0, items, TILE_ITEMS):
        own = slice(*np.searchsorted(owner, [first, first + TILE_ITEMS]))
        vocabulary, at = np.unique(term[own], return_inverse=True)
        dense = np.zeros((min(TILE_ITEMS, items - first), len(vocabulary)))
        dense[owner[own] - first, at] = times[own] * weight[term[own]]
        most, parts, begin = dense * float(MOST_QUOTIENT), [], 0
        while begin < len(vocabulary):
            room = np.flatnonzero((np.cumsum(most[:, begin:begin + TILE_TERMS], axis=1) >= EXACT).any(axis=0))
            end = min(len(vocabulary), begin + (max(1, int(room[0])) if len(room) else TILE_TERMS))
            parts.append((vocabulary[begin:end], np.ascontiguousarray(dense[:, begin:end])))
            begin = end
        tiles.append(Tile(np.arange(first, first + len(dense)), parts))
    return tiles


class Best:
    """The best documents of every item so far, by score falling, then id rising (null last)."""

    def __init__(self, top: int):
        self.top = top
        self.kept: dict[int, list[tuple[int, bool, int]]] = {}

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: (items x documents)."""
        count = scores.shape[1]
        edge = np.partition(scores, count - self.top, axis=1)[:, count - self.top] if count > self.top else np.zeros(len(scores), np.int64)
        for row, item in enumerate(items.tolist()):
            held = self.kept.get(item, [])
            least = max(int(edge[row]), -held[-1][0] if len(held) == self.top else 1, 1)
            hits = np.flatnonzero(scores[row] >= least)  # ties at the edge included
            if len(hits):
                order = np.lexsort((ids[hits], null[hits], -scores[row][hits]))[:self.top]
                new = [(-int(scores[row][j]), bool(null[j]), int(ids[j])) for j in hits[order]]
                self.kept[item] = sorted(held + new)[:self.top]

    def rows(self) -> pa.RecordBatch:
        flat = [(item, None if null else i, -s) for item, found in self.kept.items() for s, null, i in found]
        owner, ids, scores = zip(*flat, strict=True) if flat else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(owner, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text), term and tf (packed numbers of the vocabulary's terms in it) of documents with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            rows, keep = [], []
            for k, text in enumerate(batch.column("text")):
                words = terms(text.as_py())
                if words:
                    held = sorted((known[t], c) for t, c in Counter(words).items() if t in known)
                    keep.append(k)
                    rows.append((len(words), np.array([t for t, _ in held], "<i4").tobytes(), np.array([c for _, c in held], "<i8").tobytes()))
            n, found, tf = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(found, pa.binary()), pa.array(tf, pa.binary())],
                                             names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, term binary, tf binary")


def document_frequencies(held: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the vocabulary's ``size`` terms, counted in the tasks and summed on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(np.frombuffer(b"".join(batch.column("term").to_pylist()), "<i4"), minlength=size)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(count[seen])], names=["term", "df"])

    # At most as many rows as the group has terms.
    rows = held.select("term").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["term"].to_numpy(np.int64)] = rows["df"].to_numpy(np.int64)
    return out


def _search(sent, documents: int, all_terms: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, size = sent.value
        best, place = Best(top), np.full(size, -1, np.int64)
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                block = batch.slice(first, BLOCK)
                ids, null = block.column("doc_id").fill_null(0).to_numpy(), block.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                found = [np.frombuffer(x, "<i4") for x in block.column("term").to_pylist()]
                column = np.repeat(np.arange(len(found)), [len(x) for x in found])
                term = np.concatenate(found) if found else np.zeros(0, np.int32)
                tf = np.frombuffer(b"".join(block.column("tf").to_pylist()), "<i8")
                m = np.array([25 + 75 * n * documents // all_terms for n in block.column("n").to_pylist()], np.int64)
                value = quotients(tf, m[column]).astype(float)
                for tile in tiles:
                    total = np.zeros((len(tile.items), len(found)), np.int64)
                    for vocabulary, weights in tile.parts:
                        place[vocabulary] = np.arange(len(vocabulary))
                        at = place[term]
                        place[vocabulary] = -1
                        own = at >= 0
                        # Rows of terms that no document of the block holds are left out of the product.
                        marks = np.zeros(len(vocabulary), bool)
                        marks[at[own]] = True
                        impacts = np.zeros((int(marks.sum()), len(found)))
                        impacts[(np.cumsum(marks) - 1)[at[own]], column[own]] = value[own]
                        total += (weights[:, marks] @ impacts).astype(np.int64)
                    best.add(tile.items, total, ids, null)
        yield best.rows()
    return run


def _ranked_group(docs: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    """item_id, rank, doc_id, score for one bounded group of items (uid, item_id, terms with their occurrences)."""
    spark = docs.sparkSession
    got = items.select("uid", "item_id", "terms", "times").collect()
    if not got:
        return None
    numbers: dict[bytes, int] = {}
    owner, term, times = [], [], []
    for k, row in enumerate(got):
        for t, c in zip(row.terms, row.times, strict=True):
            owner.append(k)
            term.append(numbers.setdefault(bytes(t), len(numbers)))
            times.append(c)
    held, seen = materialize(document_terms(docs, numbers), "search-terms", [F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")])
    documents, all_terms = seen["documents"], seen["terms"]
    if not documents:
        return None
    df = document_frequencies(held, len(numbers))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    tiles = make_tiles(np.array(owner), np.array(term), np.array(times, np.int64), weight, len(got))
    sent = spark.sparkContext.broadcast((tiles, len(numbers)))
    found = held.mapInArrow(_search(sent, documents, all_terms, top), "item int, doc_id long, score long")
    names = F.broadcast(spark.createDataFrame([(k, r.item_id) for k, r in enumerate(got)], "item int, item_id long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(names, "item").select("item_id", "rank", "doc_id", "score")


def item_terms(items: DataFrame) -> DataFrame:
    """uid, item_id, terms, times, size of the distinct items (item_id, text) with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, c) for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True) if (c := Counter(terms(text.as_py())))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([list(c) for _, c in rows], pa.list_(pa.binary())), pa.array([list(c.values()) for _, c in rows], pa.list_(pa.int64())),
                 pa.array([len(c) for _, c in rows], pa.int64())], names=["item_id", "terms", "times", "size"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    return rows.mapInArrow(run, "item_id long, terms array<binary>, times array<long>, size long").withColumn("uid", F.monotonically_increasing_id())


def search(docs: DataFrame, items: DataFrame, top: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """The ``top`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    known = materialize(item_terms(items), "search-items")
    cut = prefix_sums(known.select("uid", "size"), ["uid"], "size", "before", name="search-order")
    groups = materialize(cut.select("uid", F.expr(f"before div {group_terms}").alias("group")), "search-groups")
    last = groups.agg(F.max("group")).first()[0]
    out = None
    for g in range(0 if last is None else last + 1):  # each holds bounded terms; one group up to a million
        found = _ranked_group(docs, known.join(groups.filter(F.col("group") == g), "uid"), top)
        if found is not None:
            found = materialize(found, "search-found") if last else found
            out = found if out is None else out.unionAll(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best ``documents`` for each ``benchmark`` item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
