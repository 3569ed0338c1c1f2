"""LM scoring: Brown class-based bigrams.

A text is its words (A-Z lower-cased, split at white space) and one end. From
the training documents come word counts ``c`` (``N`` tokens, ``V`` types), the
classes of words, and class bigram counts. The probability of a token is

    P(word | before) = P(class | class before) * P(word | class)

with ``P(word | class) = (c + 0.5) / mass(class)``, where a class's mass sums
``c + 0.5`` over its words and ``0.5 * pi`` for words never seen, and
``P(class | before) = (n(before, class) + PRIOR * P0(class)) / (n(before) + PRIOR)``,
``P0`` being the class's share of all mass. ``pi`` spreads the one unseen type
of the base model over the classes as words seen once are spread; its
probability sums over the classes, ``sum of P(class | before) * P(unseen | class)``.
All probabilities sum to one, and without class context the model is the base
model.

Classes. First units are exchanged between ``classes`` classes while the
average mutual information of adjacent classes grows. A unit is a word, for the
``own_units`` most frequent, or the ending of a word, for the ``endings`` most
frequent endings; all other words share one. Their bigram counts cover every
training token; there are ``units ** 2`` at most, and this table alone comes to
the driver. Then every further word of count ``LEAST`` or more, however many
there are, moves from the class of its ending to the class of largest gain in
the same measure, worked out in tasks, word by word. For words of the head
(below) it comes from their counts with the classes before and after them; for
all others from the classes before them, which are counted with the head's new
classes. Words of fewer occurrences keep the class of their ending. As the class
before a token, a word outside the head has the class of its ending too, so a
scan knows it without a join.

Counting the corpus: texts are split and looked up some megabytes at a time
(``lines``). Word counts are summed for each such piece and then by word, and
grow with the input. Base scores need the count of every token. The most
frequent words, ``head`` at most, are broadcast and looked up in the scan; all
other words go out as (row, word, times) and meet the counts in a join by
word. No frequent word takes part in that join, so none of its keys is hot.

Defined cases: a null or empty text is the end alone; rows with a null id are
scored but not learned from; repeated rows count as often as they occur and
each give a row; without training tokens all scores are those of empty
counts; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import table
from stockmap.session import materialize

FOLDS, HELD_OUT = 5, 1
#: Counts are compared in this many steps for each doubling when the head is cut off.
STEPS = 16
TAIL, SWEEPS = 3, 12
#: Words of this count or more get a class of their own choice.
LEAST = 4
PRIOR = 4.0
#: Bytes of text that are split at once, if no single text is longer.
PIECE = 8 << 20
#: Cells of changes that are summed at once.
CELLS = 1 << 22
END = b""


@dataclass(frozen=True)
class Sizes:
    """Units of the first exchange, number of classes, and words that are broadcast."""
    own_units: int = 768
    endings: int = 255
    classes: int = 96
    head: int = 1 << 16

    @property
    def units(self) -> int:
        return self.own_units + self.endings + 1

    @property
    def other(self) -> int:
        return self.units - 1


SIZES = Sizes()


def words_of(text: str | None) -> list[bytes]:
    """``bytes.lower`` changes A-Z only and ``bytes.split`` splits at 0x20 and 0x09-0x0D."""
    return (text or "").encode().lower().split()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(True))


@dataclass
class Vocabulary:
    """Broadcast tables of fixed size: a number (unit or class) for each head word and for each frequent ending."""
    index: dict[bytes, int]
    number: np.ndarray
    endings: dict[bytes, int]
    other: int

    def by_ending(self, word: bytes) -> int:
        return self.endings.get(word[-TAIL:], self.other)

    def mapped(self, to: np.ndarray) -> Vocabulary:
        return Vocabulary(self.index, to[self.number], {e: int(to[u]) for e, u in self.endings.items()}, int(to[self.other]))

    @cached_property
    def _arrays(self) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
        """Head words, frequent endings, and the numbers of both, at the last place the number of none of them."""
        return (pa.array([*self.index], pa.binary()), np.append(self.number, self.other).astype(np.int32),
                pa.array([*self.endings], pa.binary()), np.array([*self.endings.values(), self.other], np.int32))

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ``words``, and their places in the head (-1: not in it)."""
        head_words, number, endings, of_ending = self._arrays
        head = pc.fill_null(pc.index_in(words, value_set=head_words), -1).to_numpy()
        numbers, rest = number[head], np.flatnonzero(head < 0)
        ending = pc.index_in(pc.binary_slice(words.take(pa.array(rest)), -TAIL), value_set=endings)
        numbers[rest] = of_ending[pc.fill_null(ending, -1).to_numpy()]
        return numbers, head


@dataclass
class Lines:
    """Some texts as one row of tokens, with an end before and behind the words of each text."""
    #: All words with repeats, then the end; the place in ``words`` of each token; the tokens that are a text's first end.
    words: pa.Array
    word: np.ndarray
    first: np.ndarray

    @cached_property
    def follow(self) -> np.ndarray:
        """All tokens that have one before them."""
        inner = np.ones(len(self.word), bool)
        inner[self.first] = False
        return np.flatnonzero(inner)

    def look_up(self, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """As ``Vocabulary.look_up``, for each token."""
        numbers, head = vocab.look_up(self.words)
        return numbers[self.word], head[self.word]

    def tail(self, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The tokens to predict that are not in the head, and the place of each in the distinct words."""
        b = self.follow[head[self.follow] < 0]
        coded = self.words.take(pa.array(self.word[b])).dictionary_encode()
        return b, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def lines(texts: pa.Array) -> Iterator[Lines]:
    """The tokens of ``words_of``, for about ``PIECE`` bytes of texts at once."""
    texts = pc.fill_null(texts, "")
    piece = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE
    cuts = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(texts)]
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        if start == stop:
            continue
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts[start:stop]))
        words = parts.flatten().cast(pa.binary())
        real = pc.greater(pc.binary_length(words), 0)  # blanks around a text leave empty parts
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        counts = np.diff(np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))[ends - 1]])
        words, behind = words.filter(real), np.cumsum(counts + 2)
        word = np.full(behind[-1], len(words), np.int32)
        inner = np.ones(len(word), bool)
        inner[behind - 1] = inner[behind - 2 - counts] = False
        word[inner] = np.arange(len(words))
        yield Lines(pa.concat_arrays([words, pa.array([END], pa.binary())]), word, behind - 2 - counts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for line in lines(batch.column("text")):
            coded = line.words.dictionary_encode()
            at = coded.indices.to_numpy()
            counts = np.bincount(at)
            counts[at[-1]] = len(line.first)
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(counts, pa.int64())], names=["word", "c"])


def _bigrams(sent, units: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = sent.value
        table = np.zeros(units * units, np.int64)
        for batch in batches:
            for line in lines(batch.column("text")):
                number, b = line.look_up(vocab)[0], line.follow
                table += np.bincount(number[b - 1] * units + number[b], minlength=len(table))
        seen = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(table[seen])], names=["pair", "n"])
    return run


def _runs(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often they occur."""
    c = np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.zeros(0, np.int64)
    return c[first], np.diff(np.r_[first, len(c)])


def _neighbours(sent, own: int, classes: int):
    """(code, n) for head words after the first ``own``: place, and class before, ``classes`` + class after, or itself before."""
    slots = 2 * classes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = sent.value
        codes, size = [], 0
        for batch in batches:
            for line in lines(batch.column("text")):
                cls, place = line.look_up(vocab)
                head, b = place.astype(np.int64), line.follow
                to, of, twice = b[head[b] >= own], b[head[b - 1] >= own] - 1, b[(head[b] >= own) & (head[b] == head[b - 1])]
                codes += [head[to] * slots + cls[to - 1], head[of] * slots + classes + cls[of + 1], head[twice] * slots + 2 * classes]
                size += 2 * len(to)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _runs(codes)], names=["code", "n"])
                    codes, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _runs(codes)], names=["code", "n"])
    return run


def _class_pairs(sent, classes: int):
    """(word, slot, n): the class before each word outside the head. (pair, n): classes before and of head words, as one number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = sent.value
        table = np.zeros(classes * classes, np.int64)

        def out(words: pa.Array, pairs: pa.Array, slots: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words, pairs, pa.array(slots, pa.int32()), pa.array(n, pa.int64())], names=["word", "pair", "slot", "n"])

        for batch in batches:
            for line in lines(batch.column("text")):
                cls, head = line.look_up(vocab)
                b = line.follow
                known = b[head[b] >= 0]
                table += np.bincount(cls[known - 1] * classes + cls[known], minlength=len(table))
                b, word, words = line.tail(head)
                code, n = _runs([word * classes + cls[b - 1]])
                yield out(words.take(pa.array(code // classes)), pa.nulls(len(code), pa.int32()), code % classes, n)
        seen = np.flatnonzero(table)
        yield out(pa.nulls(len(seen), pa.binary()), pa.array(seen, pa.int32()), np.zeros(len(seen)), table[seen])
    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(n: np.ndarray, classes: int = SIZES.classes, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit from the unit bigram counts ``n``: move one unit at a time to the class that adds most."""
    units = len(n)
    weight = n.sum(axis=1) + n.sum(axis=0)
    order = np.argsort(-weight, kind="stable")
    cls = np.empty(units, np.int64)
    cls[order] = np.arange(units) % classes
    member = np.zeros((units, classes))
    member[np.arange(units), cls] = 1
    right, left = n @ member, n.T @ member  # of each unit, with the classes after and before it
    pairs = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for u in order[weight[order] > 0]:
            own, self_n = cls[u], n[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[own] -= self_n
            l[own] -= self_n
            pairs[own] -= r
            pairs[:, own] -= l
            pairs[own, own] -= self_n
            after, before = pairs.sum(axis=1), pairs.sum(axis=0)
            now = _xlogx(pairs)
            by_row, by_col = _xlogx(pairs + r) - now, _xlogx(pairs + l[:, None]) - now
            diagonal = np.diagonal(pairs)
            gain = (by_row.sum(axis=1) - np.diagonal(by_row) + by_col.sum(axis=0) - np.diagonal(by_col)
                    + _xlogx(diagonal + r + l + self_n) - _xlogx(diagonal)
                    - _xlogx(after + r.sum() + self_n) + _xlogx(after) - _xlogx(before + l.sum() + self_n) + _xlogx(before))
            new = int(gain.argmax())
            if gain[new] <= gain[own] + 1e-9:
                new = int(own)
            pairs[new] += r
            pairs[:, new] += l
            pairs[new, new] += self_n
            if new != own:
                moved += 1
                cls[u] = new
                right[:, own] -= n[:, u]
                right[:, new] += n[:, u]
                left[:, own] -= n[u]
                left[:, new] += n[u]
        if not moved:
            break
    return cls


def best_class(pairs: np.ndarray, own: int, r: np.ndarray, l: np.ndarray, self_n: float) -> int:
    """``best_classes`` of one word."""
    return int(best_classes(pairs, np.array([own]), r[None, :], l[None, :], np.array([self_n]))[0])


def best_classes(pairs: np.ndarray, own: np.ndarray, r: np.ndarray, l: np.ndarray, self_n: np.ndarray) -> np.ndarray:
    """The classes that words of classes ``own`` go to, each for itself, by the measure of ``exchange``.

    Row by row, ``r`` and ``l`` are a word's counts with the classes after and
    before it, ``self_n`` those with itself. Only cells that its counts touch
    can change, and what a count changes in a cell of another class is the
    same for all words: it is worked out once for equal counts.
    """
    w, r, l = np.arange(len(own)), r.copy(), l.copy()
    r[w, own] -= self_n
    l[w, own] -= self_n
    r_own, l_own, r_sum, l_sum = r[w, own], l[w, own], r.sum(axis=1) + self_n, l.sum(axis=1) + self_n
    after, before, diagonal = pairs.sum(axis=1) - l, pairs.sum(axis=0) - r, np.repeat(np.diagonal(pairs)[None, :], len(own), axis=0)
    after[w, own] -= r_sum
    before[w, own] -= l_sum
    diagonal[w, own] -= r_own + l_own + self_n

    def along(m: np.ndarray, counts: np.ndarray, own_n: np.ndarray, others: np.ndarray) -> np.ndarray:
        gain = np.zeros(counts.shape)
        word, touched = np.nonzero(counts)
        apart = touched != own[word]
        word, touched = word[apart], touched[apart]
        n = counts[word, touched]
        there, stays = m.T, np.zeros(len(own))
        for at in range(0, len(word), step := max(1, CELLS // len(m))):
            i = slice(at, at + step)
            (t, c), which = _distinct(touched[i], n[i])
            change = _xlogx(there[t] + c[:, None]) - _xlogx(there[t])
            change[np.arange(len(t)), t] = 0
            starts = np.flatnonzero(np.r_[True, word[i][1:] != word[i][:-1]])
            gain[word[i][starts]] += np.add.reduceat(change[which], starts, axis=0)
            cell = m[own[word[i]], touched[i]]  # without the word itself, in its own class
            stays += np.bincount(word[i], _xlogx(cell) - _xlogx(cell - n[i]), len(own))
        gain[w, own] = stays
        near = np.flatnonzero(own_n)  # next to words of its own class, where the cells are without the word too
        cells = there[own[near]] - others[near]
        change = _xlogx(cells + own_n[near, None]) - _xlogx(cells)
        change[np.arange(len(near)), own[near]] = 0
        gain[near] += change
        return gain

    gain = (along(pairs, r, r_own, l) + along(pairs.T, l, l_own, r) + _xlogx(diagonal + r + l + self_n[:, None]) - _xlogx(diagonal)
            - _xlogx(after + r_sum[:, None]) + _xlogx(after) - _xlogx(before + l_sum[:, None]) + _xlogx(before))
    new = gain.argmax(axis=1)
    return np.where(gain[w, new] <= gain[w, own] + 1e-9, own, new)


def _distinct(t: np.ndarray, c: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The distinct pairs of ``t`` and ``c``, and the place of each pair among them."""
    order = np.lexsort((c, t))
    t, c = t[order], c[order]
    new = np.r_[True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])]
    which = np.empty(len(t), np.int64)
    which[order] = np.cumsum(new) - 1
    return (t[new], c[new]), which


def _counted(held: pa.ListArray, length: int) -> np.ndarray:
    """A row of counts by slot for each list of (slot, n)."""
    row, (slot, n) = np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy(zero_copy_only=False)), held.flatten().flatten()
    counts = np.zeros((len(held), length))
    counts[row, slot.to_numpy()] = n.to_numpy()
    return counts


def _head_classes(sent, sent_pairs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, pairs = sent.value, sent_pairs.value
        k = len(pairs)
        for batch in batches:
            c = _counted(batch.column("held"), 2 * k + 1)
            chosen = best_classes(pairs, vocab.number[batch.column("place").to_numpy()], c[:, k:2 * k], c[:, :k], c[:, -1])
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(chosen, pa.int32())], names=["place", "cls"])
    return run


def _tail_classes(sent, sent_pairs):
    """(word, c, cls). (pair, c): classes before and of all words, as one number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, pairs = sent.value, sent_pairs.value
        k = len(pairs)
        table = np.zeros(k * k, np.int64)
        for batch in batches:
            of_pair = batch.filter(batch.column("pair").is_valid())
            np.add.at(table, of_pair.column("pair").to_numpy(), of_pair.column("c").to_numpy())
            batch = batch.filter(batch.column("pair").is_null())
            counts, c = _counted(batch.column("held"), k), batch.column("c").to_numpy()
            cls = vocab.look_up(batch.column("word"))[0].astype(np.int64)  # that of the ending: none of the words is in the head
            often = np.flatnonzero(c >= LEAST)
            cls[often] = best_classes(pairs, cls[often], np.zeros((len(often), k)), counts[often], np.zeros(len(often)))
            row, slot = np.nonzero(counts)
            table += np.bincount(slot * k + cls[row], counts[row, slot], k * k).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.nulls(len(batch), pa.int32()), batch.column("c"), pa.array(cls, pa.int32())],
                                             names=["word", "pair", "c", "cls"])
        seen = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(seen), pa.binary()), pa.array(seen, pa.int32()), pa.array(table[seen]), pa.nulls(len(seen), pa.int32())],
                                         names=["word", "pair", "c", "cls"])
    return run


@dataclass
class Model:
    vocab: Vocabulary
    head_count: np.ndarray
    head_score: np.ndarray
    gain: np.ndarray
    unseen: np.ndarray
    tokens: int
    total: float


def _scored_lines(line: Lines, m: Model) -> list[pa.Array]:
    """The columns after ``doc_id``, a row for each text."""
    cls, head = line.look_up(m.vocab)
    texts = len(line.first)
    text = np.repeat(np.arange(texts), np.diff(np.r_[line.first, len(line.word)]))
    known = line.follow[head[line.follow] >= 0]
    of = text[known]
    # The classes of all other words are not known here: they go out with the class before them.
    b, word, words = line.tail(head)
    classes = len(m.gain)
    code, times = _runs([(text[b] * (len(words) + 1) + word) * classes + cls[b - 1]])
    pair = code // classes
    starts = pa.array(np.searchsorted(pair // (len(words) + 1), np.arange(texts + 1)), pa.int32())
    cols = [np.bincount(text[line.follow], minlength=texts), np.bincount(of, minlength=texts), np.bincount(of, m.head_score[head[known]], texts),
            np.bincount(of, m.gain[cls[known - 1], cls[known]], texts)]
    lists = [words.take(pa.array(pair % (len(words) + 1))), pa.array(times, pa.int64()), pa.array(code % classes, pa.int32())]
    return [*(pa.array(c, t) for c, t in zip(cols, _TYPES[:4], strict=True)), *(pa.ListArray.from_arrays(starts, x) for x in lists)]


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in batches:
            rows = [_scored_lines(line, m) for line in lines(batch.column("text"))]
            cols = [pa.concat_arrays(c) for c in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in _TYPES]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=_NAMES)
    return run


_NAMES = ["doc_id", "n_tokens", "n_head", "head_score", "class_gain", "word", "times", "before"]
_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32())]
_SCHEMA = ("doc_id long, n_tokens long, n_head long, head_score double, class_gain double, word array<binary>, "
           "times array<long>, before array<int>")


def _head(counts: DataFrame, most: int):
    """Words with a count above the one that lets in more than ``most``: at most so many rows reach the driver."""
    step = F.floor(F.log2("c") * STEPS).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # 64 * STEPS rows at most
    least, held = 64 * STEPS, 0
    for r in sorted(sizes, reverse=True):
        held += r.n
        if held > most:
            break
        least = r.step
    return counts.filter(step >= least).toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)


def train(docs: DataFrame, sizes: Sizes = SIZES) -> tuple[Model, DataFrame]:
    """The model, and the words outside the head with count and class (word, c, cls) on the shared folder."""
    spark, classes, n_units = docs.sparkSession, sizes.classes, sizes.units
    send = spark.sparkContext.broadcast
    learned = docs.filter(~held_out()).select("text")
    counts, seen = materialize(learned.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts",
                               [F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")])
    tokens, total = int(seen["tokens"]), seen["tokens"] + 0.5 * (seen["types"] + 1)
    head = _head(counts, sizes.head)
    head_words, head_count = [bytes(w) for w in head["word"]], head["c"].to_numpy(float)
    own = {w: i for i, w in enumerate(head_words[:sizes.own_units])}
    listed = spark.createDataFrame([(bytearray(w), i) for w, i in own.items()], "word binary, own int")  # at most own_units rows
    ending = F.expr(f"substring(word, greatest(1, octet_length(word) - {TAIL - 1}), {TAIL})")
    of_ending = counts.join(F.broadcast(listed), "word", "left").withColumn("ending", F.when(F.col("own").isNull(), ending))
    common = of_ending.filter("own is null").groupBy("ending").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "ending").limit(sizes.endings).toPandas()
    endings = {bytes(e): sizes.own_units + i for i, e in enumerate(common["ending"])}
    units = Vocabulary({w: i for i, w in enumerate(head_words)}, np.zeros(len(head_words), np.int64), endings, sizes.other)
    units.number[:] = [own.get(w, units.by_ending(w)) for w in head_words]
    pairs = learned.mapInArrow(_bigrams(send(units), n_units), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(n_units * n_units)
    n[pairs["pair"].to_numpy(np.int64)] = pairs["n"]
    n = n.reshape(n_units, n_units)
    cls = exchange(n, classes)
    member = np.zeros((n_units, classes))
    member[np.arange(n_units), cls] = 1
    seen_pairs = send(member.T @ n @ member)
    # Further words of the head choose by the classes on both sides of them.
    vocab, slots = units.mapped(cls), 2 * classes + 1
    first = send(vocab)
    near = (learned.mapInArrow(_neighbours(first, len(own), classes), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
            .groupBy(F.expr(f"code div {slots}").cast("int").alias("place")).agg(F.collect_list(F.struct(F.expr(f"cast(code % {slots} as int) AS slot"), "n")).alias("held")))
    gained = near.mapInArrow(_head_classes(first, seen_pairs), "place int, cls int").toPandas()  # at most head rows
    gained = gained[head_count[gained["place"].to_numpy(np.int64)] >= LEAST]
    vocab = Vocabulary(vocab.index, vocab.number.copy(), vocab.endings, vocab.other)
    vocab.number[gained["place"].to_numpy(np.int64)] = gained["cls"]
    # All others choose by the class before them. None of them is hot: each makes up less than one in ``head`` tokens.
    sent = send(vocab)
    tail = (learned.mapInArrow(_class_pairs(sent, classes), "word binary, pair int, slot int, n long").repartition("word", "pair")
            .groupBy("word", "pair", "slot").agg(F.sum("n").alias("n"))
            .groupBy("word", "pair").agg(F.sum("n").alias("c"), F.collect_list(F.struct("slot", "n")).alias("held")))
    tail = materialize(tail.mapInArrow(_tail_classes(sent, seen_pairs), "word binary, pair int, c long, cls int"), "lm-words")
    words = tail.filter("word is not null").select("word", "c", "cls")
    found = tail.filter("pair is not null").groupBy("pair").agg(F.sum("c").alias("n")).toPandas()  # classes ** 2 rows
    bigrams = np.zeros(classes * classes)
    bigrams[found["pair"].to_numpy(np.int64)] = found["n"]
    bigrams = bigrams.reshape(classes, classes)
    per_class = words.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("types"), F.count_if(F.col("c") == 1).alias("once")).toPandas()
    mass, once = np.zeros(classes), np.zeros(classes)
    at = per_class["cls"].to_numpy(np.int64)
    mass[at] = per_class["c"].to_numpy(float) + 0.5 * per_class["types"].to_numpy(float)
    once[at] = per_class["once"].to_numpy(float)
    np.add.at(mass, vocab.number, head_count + 0.5)
    np.add.at(once, vocab.number, head_count == 1)
    pi = (once + 1 / classes) / (once.sum() + 1)
    share = (mass + 0.5 * pi) / total
    after = (bigrams + PRIOR * share) / (bigrams.sum(axis=1, keepdims=True) + PRIOR)
    lift = after / share
    return Model(vocab, head_count, np.log10((head_count + 0.5) / total), np.log10(lift), np.log10(lift @ pi), tokens, total), words


def scored(docs: DataFrame, sizes: Sizes = SIZES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark, classes = docs.sparkSession, sizes.classes
    model, words = train(docs, sizes)
    rows = materialize(docs.mapInArrow(_score(spark.sparkContext.broadcast(model)), _SCHEMA)
                       .withColumn("uid", F.monotonically_increasing_id()), "lm-rows")
    lifts = spark.createDataFrame([(b, k, float(g)) for b in range(classes) for k, g in enumerate([*model.gain[b], model.unseen[b]])],
                                  "before int, cls int, gain double")  # one class more: not in the corpus
    tail = rows.select("uid", F.explode(F.arrays_zip("word", "times", "before")).alias("t")).select("uid", "t.word", "t.times", "t.before")
    tail = tail.join(words, "word", "left").withColumn("cls", F.coalesce("cls", F.lit(classes))).join(F.broadcast(lifts), ["before", "cls"])
    in_corpus = tail.groupBy("uid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(model.total))).alias("tail_score"),
        F.sum(F.col("times") * F.col("gain")).alias("tail_gain"))
    out = rows.select("uid", "doc_id", "n_tokens", "n_head", "head_score", "class_gain").join(in_corpus, "uid", "left").na.fill(
        0, ["tail_known", "tail_score", "tail_gain"])
    base = F.col("head_score") + F.col("tail_score")
    score = base + F.col("class_gain") + F.col("tail_gain")
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", (F.col("n_head") + F.col("tail_known")).alias("n_known"),
                      F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
                      F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))


def op1_class_ngrams(spark, sf_dir: str) -> DataFrame:
    """Score of every whole text of ``documents`` under the class model and the base model."""
    return scored(table(spark, sf_dir, "documents"))
