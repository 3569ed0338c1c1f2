"""Connected components of a link table by rewiring to smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmap.session import materialize

#: Links that one written file holds, about.
FILE_LINKS = 200_000


def components(links: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """``node``, ``root``: for each node with a larger number than its component's smallest, that smallest node.

    In each round every node links all its neighbours and itself to the
    smallest of them. The rounds, logarithmic in number, end when each node is
    either the smallest of its neighbours or has one neighbour only: all
    components are stars then. A round joins links with the smallest neighbour
    of their end, so a hub with very many links is a skewed join, not one
    group. The links of each round are written to the shared folder. Roots
    themselves are not listed.
    """
    rows = [F.count(F.lit(1)).alias("n")]
    edges, seen = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), name, rows)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        if ends.filter("low < u AND high <> low").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        least = ends.select("u", F.least("low", "u").alias("m"))
        rewired = both.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges, seen = materialize(rewired.coalesce(1 + seen["n"] // FILE_LINKS), name, rows)
