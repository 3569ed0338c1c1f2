"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get dense numbers in ``doc_id`` order. A keyed Feistel network on the
rectangle ``a x b`` (the smallest near-square one that holds all ``n`` rows)
permutes the numbers; a value that lands outside ``0..n-1`` is sent through
the network again until it lands inside (cycle walking), so the result is a
permutation of exactly ``n`` numbers. Shard and slot follow from the permuted
number alone: ``shard = p mod shards``, ``slot = p div shards``. Anyone can
compute where row ``i`` lies from ``(i, n, seed)`` without data.

Law ``rows``: shard counts differ by at most one and slots are gapless.

Defined cases: a null text has 0 bytes and checksum 0; null and repeated ids
are rows like any other (nulls come first; equal rows share the numbers among
themselves); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import prefix_sums, table
from stockmap.session import materialize

SHARDS = 24
SEED = 20
HALF_ROUNDS = 6
#: Primes of the round function.
P, Q = 2147483647, 2147483629
#: Out-of-range values are at most a 2/sqrt(n) share, so a longer walk has no chance to occur; it would raise an error.
MAX_WALK = 64


def round_keys(seed: int) -> list[tuple[int, int, int, int]]:
    """Four multipliers and shifts for each half round, from the seed by a Lehmer sequence."""
    out, x = [], (seed * 2654435761 + 12345) % P or 1
    for _ in range(HALF_ROUNDS):
        key = []
        for _ in range(4):
            x = x * 48271 % P
            key.append(x)
        out.append(tuple(key))
    return out


def rectangle(n: int) -> tuple[int, int]:
    a = math.isqrt(n - 1) + 1 if n > 1 else 1
    return a, max(1, -(-n // a))


def feistel_sql(x: str, a: int, b: int, seed: int, div: str = "div") -> str:
    """SQL text for one pass of the network; each half round shifts one half by a hash of the other."""
    left, right = f"(({x}) {div} {b})", f"(({x}) % {b})"
    for k, (m1, c1, m2, c2) in enumerate(round_keys(seed)):
        def mixed(v: str) -> str:
            return f"(((({v} * {m1} + {c1}) % {P}) * {m2} + {c2}) % {Q})"
        if k % 2 == 0:
            left = f"(({left} + {mixed(right)}) % {a})"
        else:
            right = f"(({right} + {mixed(left)}) % {b})"
    return f"({left} * {b} + {right})"


def permute(index: int, n: int, seed: int = SEED) -> int:
    """The same permutation in plain Python: where a row lands, computed without data."""
    a, b = rectangle(n)
    x = index
    while True:
        left, right = divmod(x, b)
        for k, (m1, c1, m2, c2) in enumerate(round_keys(seed)):
            if k % 2 == 0:
                left = (left + ((right * m1 + c1) % P * m2 + c2) % Q) % a
            else:
                right = (right + ((left * m1 + c1) % P * m2 + c2) % Q) % b
        x = left * b + right
        if x < n:
            return x


def feistel_shards(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (narrow) with ``shard`` and ``slot`` from the permuted row number in ``order``."""
    rows = materialize(rows.withColumn("_one", F.lit(1).cast("long")), "shards")
    n = rows.count()
    if not n:
        return rows.drop("_one").withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")})
    a, b = rectangle(n)
    numbered = prefix_sums(rows, order, "_one", "_i", name="shards-order")
    walk = (f"CASE WHEN _p < {n} THEN _p ELSE aggregate(sequence(1, {MAX_WALK}), _p, (v, k) -> "
            f"CASE WHEN v < {n} THEN v ELSE {feistel_sql('v', a, b, seed)} END, "
            f"v -> CASE WHEN v < {n} THEN v ELSE CAST(raise_error('walk too long') AS BIGINT) END) END")
    out = numbered.withColumn("_p", F.expr(feistel_sql("_i", a, b, seed))).withColumn("_p", F.expr(walk))
    return out.withColumns({"shard": F.expr(f"CAST(_p % {shards} AS INT)"), "slot": F.expr(f"_p div {shards}")}).drop(
        "_one", "_i", "_p")


def op9_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its shard (0 to 23) and slot under law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    out = feistel_shards(rows, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
