"""Packing: order-preserving dynamic programming over cut points.

Each task takes its documents in table order as one stream of token ids and
cuts it into windows of at most ``WINDOW`` ids. Cuts may fall at the end of a
document (free), at the end of a sentence (``SENTENCE_CUT``) and, only where
no such end occurs for ``STRETCH`` ids, within a sentence (``HARD_CUT`` each
``STEP`` ids). The cuts minimise

    sum over windows of (WINDOW - length) + penalties of the cuts.

With ``cost[j]`` for a stream that ends at candidate ``c[j]`` this is
``cost[j] = WINDOW - c[j] + penalty[j] + min(cost[i] + c[i])`` over the
candidates ``i`` at most ``WINDOW`` before: a sliding minimum, kept in a
monotone queue, so the time is linear in the number of candidates. A stream
is solved in blocks of ``BLOCK`` ids; all but the last ``OVERLAP`` windows of
a block are final, the rest is solved again with the next block. Memory is
bounded by a block and one document, nothing is shuffled, and only the last
window of each task is short for want of documents.

Ids are those of the byte-level vocabulary ``byte_bpe_50k``; ``encoder`` says
which library makes them. The end-of-document id is appended to each document.

Defined cases: a null or empty text is the end id alone; repeated rows and null
ids are documents of their own; an empty table gives an empty result; further
columns are ignored. Sequence ids are unique: task number, then count.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import table

WINDOW = 2048
END_ID = 1
SENTENCE_CUT, HARD_CUT = 4, 12
STRETCH, STEP = 48, 16
BLOCK, OVERLAP = 1 << 19, 8


def encoder(name: str = "byte_bpe_50k") -> Callable[[str], np.ndarray]:
    """Text to ids. ``tiktoken`` reads the vocabulary as ranks and is about six times as fast as ``tokenizers``
    on the same ids (tests compare them); a text on which it gives up goes through ``tokenizers``."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = None

    def encode(text: str) -> np.ndarray:
        nonlocal slow
        try:
            return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        except (ValueError, RuntimeError):
            if slow is None:
                from tokenizers import Tokenizer

                slow = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
                slow.encode_special_tokens = True
            return np.asarray(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    encode.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    return encode


def sentence_tables(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each id: does it end a sentence if white space follows; does it start with white space; does it end a line."""
    n = max(len(tokens), END_ID) + 1
    stop, space, line = (np.zeros(n, bool) for _ in range(3))
    for i, t in enumerate(tokens):
        stop[i] = t.rstrip(b"\"')]").endswith((b".", b"!", b"?"))
        space[i] = t[:1] in (b" ", b"\n", b"\t", b"\r")
        line[i] = t.endswith(b"\n")
    return stop, space, line


def sentence_ends(ids: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Offsets in a document at which a sentence or a line has just ended, without 0 and the document's end."""
    stop, space, line = tables
    return np.flatnonzero((stop[ids[:-1]] & space[ids[1:]]) | line[ids[:-1]]) + 1


def candidates(ends: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut points after 0 and their penalties; ``ends``: ends of documents, rising, the last one that of the stream."""
    points = np.concatenate([ends, sentences])
    cost = np.concatenate([np.zeros(len(ends), np.int64), np.full(len(sentences), SENTENCE_CUT, np.int64)])
    order = np.lexsort((cost, points))
    points, cost = points[order], cost[order]
    first = np.r_[True, points[1:] != points[:-1]]
    points, cost = points[first], cost[first]
    gaps = np.diff(points, prepend=0)
    hard = [np.arange(p - g + STEP, p, STEP) for p, g in zip(points[gaps > STRETCH], gaps[gaps > STRETCH], strict=True)]
    if hard:
        extra = np.concatenate(hard)
        points, cost = np.concatenate([points, extra]), np.concatenate([cost, np.full(len(extra), HARD_CUT, np.int64)])
        order = np.argsort(points, kind="stable")
        points, cost = points[order], cost[order]
    return points, cost


def best_cuts(points: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """The cuts of least cost, the last point included."""
    at, pen = [0, *points.tolist()], [0, *penalty.tolist()]
    value, came = [0] * len(at), [0] * len(at)  # value: cost[j] + c[j]
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        low = at[j] - window
        while at[queue[0]] < low:
            queue.popleft()
        i = came[j] = queue[0]
        v = value[j] = value[i] + window + pen[j]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


class Stream:
    """Documents in order to pieces: ``add`` documents, ``flush`` what is final."""

    def __init__(self, first_sequence: int, tables: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.sequence, self.tables = first_sequence, tables
        self.docs: list[list] = []  # doc_id, ids, offset of the first id that is still open, sentence ends
        self.open = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append([doc_id, ids, 0, sentence_ends(ids, self.tables)])
        self.open += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        if not self.docs:
            return []
        starts, ends, sentences, at = [], [], [], 0
        for _, ids, begun, stops in self.docs:
            starts.append(at)
            sentences.append(stops[stops > begun] - begun + at)
            at += len(ids) - begun
            ends.append(at)
        cuts = best_cuts(*candidates(np.array(ends, np.int64), np.concatenate(sentences)))
        if not last:
            cuts = cuts[:max(0, len(cuts) - OVERLAP)]
        rows, k, begin = [], 0, 0
        for cut in cuts:
            offset = 0
            while begin < cut:
                doc_id, ids, begun, _ = self.docs[k]
                start, stop = begun + begin - starts[k], begun + min(cut, ends[k]) - starts[k]
                rows.append((doc_id, start, stop - start, zlib.crc32(ids[start:stop].astype("<u4", copy=False).data),
                             len(ids), self.sequence, offset))
                offset += stop - start
                begin += stop - start
                k += begin == ends[k]
            self.sequence += 1
        if begin:
            rest = self.docs[k:]
            if rest:
                rest[0][2] += begin - starts[k]
            self.docs = rest
            self.open = at - begin
        return rows


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_ARROW)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stream, encode, end = None, None, np.array([END_ID], np.uint32)
    for batch in batches:
        if encode is None:
            encode = encoder()
            stream = Stream(TaskContext.get().partitionId() << 40, sentence_tables(encode.tokens))
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            stream.add(doc_id, np.concatenate([encode(text.as_py() or ""), end]))
            if stream.open >= BLOCK and (rows := stream.flush(False)):
                yield _rows(rows)
    if stream and (rows := stream.flush(True)):
        yield _rows(rows)


def pack(docs: DataFrame) -> DataFrame:
    """One row for each piece of each document of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack, SCHEMA)


def op2_pack_windows(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
