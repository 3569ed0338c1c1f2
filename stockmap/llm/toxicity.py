"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features of a text are the hashed byte n-grams (``SIZES``) of its form with
A-Z lower-cased and white space as blanks, each present or not. From labelled
texts come, for each n-gram, the numbers of toxic and clean documents that
hold it and the ratio

    r = log((toxic + 1) / (toxic_docs + 2)) - log((clean + 1) / (clean_docs + 2)).

N-grams in at least ``MIN_DOCS`` documents, the ``KEPT`` largest by ``|r|``
times the root of the documents that hold them, stay. A logistic regression is fitted on
the features scaled by ``r`` (so an n-gram that tells nothing has no say) with
an L2 penalty; its weight for an n-gram is ``r`` times the fitted value.

Counts, and so ratios and the choice of n-grams, come from every labelled
document that is not held out, whatever their number: texts meet their labels
in a join by id, each task packs its counts in blocks of ``BLOCK`` n-grams, and
blocks are summed on the executors. Only the regression takes a bounded sample:
at most ``PER_CLASS`` labelled documents of each class, those whose ids have
the smallest hashes. The driver gets the kept n-grams and, for each document of
the sample, the places of those it holds as packed 4-byte numbers. The model is
one table of ``2**BITS`` 4-byte weights (4 MB), broadcast whatever the input.
Scoring is one pass over all texts without a shuffle.

Defined cases: a null or empty text has the score of the intercept; of
several labels of an id the largest counts; null ids are never learned from;
of a repeated id each row is counted and one text is in the sample; without labels of both classes
every score is the smoothed share of toxic labels, and ``keep_clean`` keeps every row, as nothing was learned
that could reject one; further columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import distinct_sorted, quoted, table
from stockmap.session import materialize

SIZES = (4, 5, 6)
BITS = 20
MIN_DOCS, KEPT = 5, 50_000
PER_CLASS = 8_000
#: N-grams in one packed block of counts.
BLOCK = 1 << 10
L2, STEPS, RATE = 1.0, 300, 0.05
FOLDS, HELD_OUT = 5, 0

_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[:33] = 32
#: Odd multipliers of the n-gram hash.
_MIX = {n: np.uint64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * 2 * n & 0xFFFFFFFFFFFFFFFF | 1) for n in SIZES}
_PIECE = 1 << 20


def ngrams(texts: list[bytes], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, n-gram) pairs, rising, of the n-grams that ``keep`` marks."""
    padded = np.array([len(t) + 2 for t in texts], np.int64)
    ends = np.cumsum(padded)
    joined = _FORM[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    most, found = max(SIZES), []
    for at in range(0, len(joined), _PIECE):
        b = joined[at:at + _PIECE + most - 1].astype(np.uint64)
        pairs = b[:-1] | b[1:] << np.uint64(8)
        four = pairs[:-2] | pairs[2:] << np.uint64(16)
        grams = {4: four, 5: four[:-1] | b[4:] << np.uint64(32), 6: four[:-2] | pairs[4:] << np.uint64(32)}
        for n in SIZES:
            ids = (grams[n][:_PIECE] * _MIX[n] >> np.uint64(64 - BITS)).astype(np.int64)
            hits = np.flatnonzero(keep[ids])
            text = np.searchsorted(ends, hits + at, side="right")
            inside = hits + (at + n) <= ends[text]
            found.append(distinct_sorted(text[inside] << BITS | ids[hits[inside]]))
    pairs = distinct_sorted(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _groups(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts as bytes, about a megabyte at a time."""
    group, held = [], 0
    for t in texts.cast(pa.binary()):
        group.append(t.as_py() or b"")
        held += len(group[-1])
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    #: Was it fitted on labels of both classes?
    fitted: bool = True

    def score(self, texts: list[bytes]) -> np.ndarray:
        text, gram = ngrams(texts, self.weights != 0)
        z = np.bincount(text, self.weights[gram], len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out() -> Column:
    """Is this document kept out of all learning? A null id is (it never has a label)."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def _known(labels: DataFrame) -> DataFrame:
    """One label for each id that is not held out: doc_id, toxic."""
    return labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").alias("toxic")).filter(~held_out())


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row to learn from: toxic, text. Merge join, so that all sizes of input run the same plan."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).filter(~held_out())
    return texts.join(_known(labels).hint("merge"), "doc_id").select("toxic", "text")


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The bounded sample of the regression: doc_id, toxic, text."""
    known = _known(labels)
    ids = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    by_class = [ids.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = by_class[0].unionAll(by_class[1])  # at most 2 * per_class rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros((2, 1 << BITS), np.int64)
    docs, everything = np.zeros(2, np.int64), np.ones(1 << BITS, bool)
    for batch in batches:
        toxic, at = np.array(batch.column("toxic").to_pylist(), np.int64), 0
        for group in _groups(batch.column("text")):
            text, gram = ngrams(group, everything)
            y = toxic[at:at + len(group)]
            at += len(group)
            for c in (0, 1):
                held[c] += np.bincount(gram[y[text] == c], minlength=1 << BITS)
                docs[c] += int((y == c).sum())
    blocks = held.reshape(2, -1, BLOCK)
    seen = np.flatnonzero(blocks.any(axis=(0, 2)))
    packed = [zlib.compress(x.tobytes(), 1) for x in (docs, *(blocks[:, k] for k in seen))]
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, seen]), pa.array(packed, pa.binary())], names=["block", "counts"])


def _sum_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block -1 holds the numbers of documents and comes out as n-gram -1."""
    total = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for batch in batches for x in batch.column("counts")).reshape(2, -1)
    block, seen = key[0].as_py(), np.flatnonzero(total.any(axis=0))
    grams = seen + block * BLOCK if block >= 0 else seen - 1
    yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(total[0][seen]), pa.array(total[1][seen])], names=["gram", "clean", "toxic"])


def count(rows: DataFrame) -> DataFrame:
    """For each n-gram of ``rows`` (toxic, text): gram, and the clean and toxic documents that hold it; n-gram -1 has all documents."""
    return rows.mapInArrow(_count, "block long, counts binary").groupBy("block").applyInArrow(_sum_blocks, "gram long, clean long, toxic long")


def _kept_features(keep):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, place = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, "<u4")
        marks[keep.value] = True
        place[keep.value] = np.arange(len(keep.value))
        for batch in batches:
            toxic, at = batch.column("toxic").to_pylist(), 0
            for group in _groups(batch.column("text")):
                text, gram = ngrams(group, marks)
                cuts = np.searchsorted(text, np.arange(1, len(group)))
                rows = [g.tobytes() for g in np.split(place[gram], cuts)]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[at:at + len(group)], pa.int32()), pa.array(rows, pa.binary())], names=["toxic", "grams"])
                at += len(group)
    return run


def _sums(at: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values[at]`` between consecutive ``starts``, some thousands of groups' entries at a time."""
    out, n = np.zeros(len(starts) - 1), len(starts) - 1
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _PIECE, side="right")) - 1)
        filled = np.flatnonzero(starts[lo + 1:hi + 1] > starts[lo:hi]) + lo
        if len(filled):
            out[filled] = np.add.reduceat(values[at[starts[lo]:starts[hi]]], starts[filled] - starts[lo])
        lo = hi
    return out


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on present features scaled by ``r``, by Adam on the whole sample.

    The sample is held twice as narrow numbers, by document and by n-gram, so
    both sums of a step run over neighbouring entries.
    """
    by_doc = np.concatenate(rows)
    doc_starts = np.r_[0, np.cumsum([len(x) for x in rows])].astype(np.int64)
    gram_starts = np.r_[0, np.cumsum(np.bincount(by_doc, minlength=len(r)))].astype(np.int64)
    by_gram, free = np.empty(len(by_doc), np.min_scalar_type(len(rows))), gram_starts[:-1].copy()
    for lo in range(0, len(by_doc), _PIECE):  # some entries at a time, since sorting all of them takes several times their size
        some = by_doc[lo:lo + _PIECE]
        order, n = np.argsort(some, kind="stable"), np.bincount(some, minlength=len(r))
        docs = np.searchsorted(doc_starts, order + lo, side="right") - 1
        by_gram[np.repeat(free - np.cumsum(n) + n, n) + np.arange(len(some))] = docs
        free += n
    v, b = np.zeros(len(r)), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    first, second = np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    for step in range(1, STEPS + 1):
        z = _sums(by_doc, doc_starts, r * v) + b
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        g = np.r_[r * _sums(by_gram, gram_starts, error) + L2 * v, error.sum()] / len(rows)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        v -= move[:-1]
        b -= move[-1]
    return v, b


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    spark = docs.sparkSession
    counts = materialize(count(labelled(docs, labels)), "toxicity-counts")
    n = counts.filter("gram < 0").agg(F.coalesce(F.sum("clean"), F.lit(0)).alias("clean"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    weights = np.zeros(1 << BITS, np.float32)
    prior = (n.toxic + 0.5) / (n.clean + n.toxic + 1)
    if not (n.clean and n.toxic):
        return Model(weights, float(np.log(prior / (1 - prior))), fitted=False)
    ratio = F.log((F.col("toxic") + 1) / (n.toxic + 2)) - F.log((F.col("clean") + 1) / (n.clean + 2))
    held = F.col("clean") + F.col("toxic")
    best = (counts.filter((F.col("gram") >= 0) & (held >= MIN_DOCS)).select("gram", ratio.alias("r"), held.alias("held"))
            .orderBy(F.desc(F.abs("r") * F.sqrt("held")), "gram").limit(KEPT).toPandas().sort_values("gram"))
    keep, r = best["gram"].to_numpy(np.int64), best["r"].to_numpy()
    sent = spark.sparkContext.broadcast(keep)
    features = sample(docs, labels, per_class).mapInArrow(_kept_features(sent), "toxic int, grams binary")
    narrow = np.min_scalar_type(len(keep))
    rows = [(np.frombuffer(x.grams, "<u4").astype(narrow), x.toxic) for x in materialize(features, "toxicity-sample").toLocalIterator()]
    v, intercept = fit_logistic([x for x, _ in rows], np.array([y for _, y in rows], float), r)
    weights[keep] = r * v
    return Model(weights, intercept)


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``own`` (a struct of the columns of ``docs``, of any name) and ``score`` of its ``text``, in one pass without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows, at = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("own")), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own")
            scores = [sent.value.score(g) for g in _groups(own.field(at))]
            yield pa.RecordBatch.from_arrays([own, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["own", "score"])

    return rows.mapInArrow(run, rows.select("own", F.lit(0.0).alias("score")).schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = with_score(docs, train(docs, labels)).select("own.doc_id", "score")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns; all rows without a fitted classifier."""
    model = train(docs, labels)
    return with_score(docs, model).filter(F.col("score") < 0.5).select("own.*") if model.fitted else docs


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
