"""Quality: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of word characters (ASCII letters, digits, characters beyond
ASCII) and runs of punctuation, case kept. Features are words, pairs of
neighbouring words, and triples of word shapes (capitals, first capital,
digits, lower case, the word before once more; punctuation stands for itself),
each hashed to one of ``2**BITS`` places. A feature's value is ``log(1 + times)``,
and a text's values are scaled to length one. A score is the logistic function
of one sparse dot product and the bias.

Training: per-coordinate FTRL-proximal (``ALPHA``, ``BETA``, ``L1``, ``L2``)
with its two sums ``z`` and ``n`` for each place. The sample (at most
``PER_CLASS`` labelled documents of each class, those whose ids have the
smallest hashes) is written once, dealt to ``SHARDS`` shards in a fixed order. In each of
``ROUNDS`` rounds every shard goes on from the common state on an executor,
one document after the other; the changes are averaged over shards, block by
block of ``BLOCK`` places, on the executors. The driver holds the state (two
numbers for each place), never a document. Documents of a class count as many
times as the class has labelled documents for each one sampled, so scores stay
probabilities where the bound bites. Scoring is one pass over all texts
without a shuffle.

Defined cases: a null or empty text has the score of the bias; of several
labels of an id the largest counts; null ids and labels that are neither 0 nor
1 are never learned from; of a repeated id one text is in the sample; without
labels of both classes every score is the smoothed share of label 1; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import table
from stockmap.session import materialize

BITS = 19
PER_CLASS = 10_000
SHARDS, ROUNDS, BLOCK = 8, 6, 1 << 12
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.02, 0.02
FOLDS, HELD_OUT = 5, 0
ACCEPT = 0.3

_M64 = (1 << 64) - 1
#: Odd constants of the token hash and its mixing.
_BASE, _MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: 0: white space and control characters, 1: word characters, 2: punctuation.
_KIND = np.array([1 if b > 127 or chr(b).isalnum() else 2 if 32 < b < 127 else 0 for b in range(256)], np.uint8)
CAPITALS, FIRST_CAPITAL, DIGITS, LOWER, AGAIN = 1, 2, 3, 4, 5


class _Powers:
    """Powers of the hash base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            factors = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            for f in factors:
                f[0] = 1
            self.up, self.down = (np.multiply.accumulate(f) for f in factors)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(_MIX[k])
    return h ^ h >> np.uint64(29)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and shape of every token of ``texts``."""
    b = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[b]
    edge = np.flatnonzero(np.diff(kind, prepend=0))  # the last character is white space
    start = edge[kind[edge] > 0]
    end = np.append(edge[1:], len(b))[kind[edge] > 0]
    up, down = _POWERS.get(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[1:])])
    h = _mixed((sums[end] - sums[start]) * down[start], 0)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")

    def held(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mark)])
        return total[end] - total[start]

    upper = (b >= 65) & (b <= 90)
    n_upper, n_lower, n_digit = held(upper), held((b >= 97) & (b <= 122)), held((b >= 48) & (b <= 57))
    shape = np.select([(n_upper > 0) & (n_lower == 0) & (end - start > 1), upper[start], n_digit == end - start],
                      [CAPITALS, FIRST_CAPITAL, DIGITS], LOWER).astype(np.uint64)
    again = np.r_[False, (h[1:] == h[:-1]) & (text[1:] == text[:-1])] if len(h) else np.zeros(0, bool)
    shape[again] = AGAIN
    punctuation = kind[start] == 2
    shape[punctuation] = h[punctuation]
    return text, h, shape


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and value of every feature of ``texts``, by text and place."""
    text, h, shape = tokens(texts)
    two, three = text[1:] == text[:-1], text[2:] == text[:-2]
    shaped = _mixed(_mixed(_mixed(shape[:-2], 1) + shape[1:-1], 2) + shape[2:], 3)
    found = [(text, h), (text[1:][two], _mixed(_mixed(h[:-1], 1) + h[1:], 2)[two]), (text[2:][three], shaped[three])]
    pairs = np.sort(np.concatenate([t << BITS | (_mixed(x, 3) >> np.uint64(64 - BITS)).astype(np.int64) for t, x in found]))
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, np.int64)
    value = np.log1p(np.diff(first, append=len(pairs)))
    owner = pairs[first] >> BITS
    length = np.sqrt(np.bincount(owner, value * value, len(texts)))
    return owner, pairs[first] & ((1 << BITS) - 1), value / length[owner]


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


def _logistic(z: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class State:
    """FTRL sums of every place; the bias is the last."""
    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls) -> State:
        return cls(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, y: int, weight: float) -> None:
        """One document: ``at`` and ``value`` with the bias at the end."""
        w = self.weights(at)
        g = (_logistic(float(w @ value)) - y) * weight * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        text, at, value = features(texts)
        return _logistic(np.bincount(text, self.weights[at] * value, len(texts)) + self.bias)


def held_out() -> Column:
    """Is this document kept out of all learning? A null id is (it never has a label)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, quality, text)`` of the bounded sample (a repeated id has all its rows), and the labelled documents of each class."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("quality")).filter(~held_out())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = materialize(known.join(texts.select("doc_id"), "doc_id", "left_semi"), "quality-known")
    totals = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = [known.filter(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))  # at most 2 * per_class rows of two numbers
    return texts.join(ids, "doc_id"), totals


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's places and values, the bias last."""
    for batch in batches:
        at = 0
        for group in _groups(batch.column("text")):
            text, place, value = features(group)
            cuts = np.searchsorted(text, np.arange(1, len(group)))
            places = [np.append(x, 1 << BITS).astype("<i4").tobytes() for x in np.split(place, cuts)]
            values = [np.append(x, 1.0).astype("<f4").tobytes() for x in np.split(value, cuts)]
            own = batch.slice(at, len(group))
            yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("quality"), pa.array(places, pa.binary()), pa.array(values, pa.binary())],
                                             names=["doc_id", "quality", "places", "values"])
            at += len(group)


def _changes(shard: int, old: State, new: State) -> pa.RecordBatch:
    """Changed blocks of one shard: block, change of z and n."""
    change = [np.append(b - a, np.zeros(-len(a) % BLOCK)).reshape(-1, BLOCK) for a, b in ((old.z, new.z), (old.n, new.n))]
    moved = np.flatnonzero(change[0].any(axis=1) | change[1].any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array([shard] * len(moved), pa.int32()), pa.array(moved, pa.int32()),
                                       pa.array([np.stack([change[0][k], change[1][k]]).tobytes() for k in moved], pa.binary())], names=["shard", "block", "change"])


def _one_pass(sent, weight: dict[int, float]):
    """The documents of this task, shard by shard, each from the common state; of a repeated id the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, state, old, last = None, None, sent.value, None
        for batch in batches:
            for own, doc, y, places, values in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "quality", "places", "values")), strict=True):
                if own != shard:
                    if state is not None:
                        yield _changes(shard, old, state)
                    shard, state = own, State(old.z.copy(), old.n.copy())
                if doc != last:
                    state.learn(np.frombuffer(places, "<i4"), np.frombuffer(values, "<f4").astype(float), y, weight[y])
                last = doc
        if state is not None:
            yield _changes(shard, old, state)
    return run


def _sum_changes(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum over shards, in their order (so that reruns agree to the last bit); at most ``SHARDS`` rows."""
    rows = sorted((s, x) for b in batches for s, x in zip(b.column("shard").to_pylist(), b.column("change").to_pylist(), strict=True))
    total = sum(np.frombuffer(x, "<f8") for _, x in rows)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "change"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, shards: int = SHARDS, rounds: int = ROUNDS) -> Model:
    spark = docs.sparkSession
    rows, totals = sample(docs, labels, per_class)
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not (n0 and n1):
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return Model(np.zeros(1 << BITS), float(np.log(share / (1 - share))))
    each = {c: n / min(n, per_class) for c, n in ((0, n0), (1, n1))}
    mean = (n0 + n1) / (min(n0, per_class) + min(n1, per_class))
    weight = {c: w / mean for c, w in each.items()}
    key = F.xxhash64(F.col("doc_id"), F.lit("order"))
    # Dealt and sorted once. A shard is one row group of one file, which one task reads in order, whatever the splits
    # (only a shard beyond 128 MB may be gone through in pieces, each from the common state).
    known = materialize(rows.mapInArrow(_packed, "doc_id long, quality int, places binary, values binary")
                        .withColumns({"order": key, "shard": F.pmod(key, F.lit(shards)).cast("int")})
                        .repartition(shards, "shard").sortWithinPartitions("shard", "order", "doc_id", "places"), "quality-sample")
    state = State.empty()
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(state)
        moved = known.mapInArrow(_one_pass(sent, weight), "shard int, block int, change binary").groupBy("block").applyInArrow(_sum_changes, "block int, change binary")
        state = State(state.z.copy(), state.n.copy())
        for r in moved.collect():  # at most as many numbers as the state has
            at = slice(r.block * BLOCK, min((r.block + 1) * BLOCK, len(state.z)))
            dz, dn = np.frombuffer(r["change"], "<f8").reshape(2, -1)[:, :at.stop - at.start] / shards
            state.z[at] += dz
            state.n[at] += dn
        sent.unpersist()
    w = state.weights(slice(None))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(g) for g in _groups(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["doc_id", "score"])

    out = docs.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op13_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
