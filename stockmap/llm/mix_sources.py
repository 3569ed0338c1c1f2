"""Mixing sources to target weights: Efraimidis-Spirakis sampling to token budgets.

1. Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating.
   Together they share ``share`` times all words. A source's target stops at
   ``most`` times its own words; what is above is shared again by weight. The
   end of that process is a water level: ``target = min(most * size, level * weight)``.
2. Complete epochs. ``floor(target / size)`` copies of every document.
3. Fractional selection. Each document draws ``u`` in (0, 1) from a digest of
   its id and gets the exponential key ``-ln(u) / weight``, where the weight
   is its quality weight. Sorted by key within the source, documents are
   taken while the prefix sum of their words stays within the rest of the
   budget; the document at the edge gives the words that are still missing
   or, with ``whole``, is taken if that brings the source nearer its target.

Prefix sums run over many tasks for each source (see ``prefix_sums``), so one
source may hold any share of the rows. Nothing is collected but the water level.

Defined cases: a null or blank text has size 0 and gives nothing; a source of
size 0 has target 0; a null source is a source of its own; repeated rows each
count; a null id is drawn like an id of its own; without rows the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import WORD_RE, prefix_sums, table, text_tag, with_count
from stockmap.session import materialize

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
#: Quality weight by label; documents without a label weigh 1.
GOOD, POOR, UNKNOWN = 2.0, 0.5, 1.0
SEED = "mix-1"


def source_targets(sized: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row for each source: ``source``, ``source_size``, ``target``."""
    per = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                      .withColumns({"_null": F.col("source").isNull().cast("int"), "_one": F.lit(1).cast("long")}), "mix-sources")
    ranked = prefix_sums(per, ["_null", "source"], "_one", "_rank", name="mix-rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("_w", weight).withColumn("_cap", F.lit(most) * F.col("source_size"))
                         .withColumn("_full_at", F.col("_cap") / F.col("_w")).select(
                             "source", "source_size", "_w", "_cap", "_full_at"), "mix-weights")
    totals = ranked.agg(F.sum("source_size").alias("n"), F.sum("_w").alias("w")).first()
    if not totals.n:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    # The level: sources fill up in the order of cap / weight; the first that the remaining budget cannot fill sets it.
    filled = prefix_sums(ranked, ["_full_at", "source"], "_cap", "_cap_before", name="mix-caps")
    filled = prefix_sums(filled, ["_full_at", "source"], "_w", "_w_before", name="mix-level")
    level_here = (F.lit(share * totals.n) - F.col("_cap_before")) / (F.lit(totals.w) - F.col("_w_before"))
    level = (filled.withColumn("_level", level_here).filter(F.col("_level") <= F.col("_full_at"))
             .agg(F.min_by("_level", "_full_at").alias("v")).first().v)
    target = F.col("_cap") if level is None else F.least(F.col("_cap"), F.lit(level) * F.col("_w"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None, share: float = SHARE, most: float = MOST, whole: bool = False) -> DataFrame:
    """``docs`` (doc_id, source, size, more) with ``source_size``, ``target`` and ``taken``; ``quality``: doc_id, weight."""
    sized = docs
    if quality is not None:
        sized = sized.join(quality.select(F.col("doc_id").alias("_qid"), F.col("weight").alias("_qw")),
                           F.col("doc_id") == F.col("_qid"), "left").drop("_qid")
    else:
        sized = sized.withColumn("_qw", F.lit(UNKNOWN))
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 12)
    u = (F.conv(digest, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 48)
    sized = materialize(sized.withColumn("_key", -F.log(u) / F.coalesce(F.col("_qw"), F.lit(UNKNOWN))).drop("_qw"), "mix-docs")
    targets = materialize(source_targets(sized, share, most), "mix-targets")
    drawn = prefix_sums(sized, ["_key", "doc_id", "size"], "size", "_before", group="source", name="mix-order")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    drawn = drawn.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target")).cast("long") - F.col("_epochs") * F.col("source_size")
    left = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("_before")))
    if whole:
        left = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long"))
    return (drawn.withColumn("_epochs", epochs)
            .withColumn("taken", F.col("_epochs") * F.col("size") + left)
            .drop("_key", "_before", "_epochs"))


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def label_weights(labels: DataFrame) -> DataFrame:
    """One weight for each labelled id; of several labels of an id the best counts."""
    best = labels.groupBy("doc_id").agg(F.max("quality").alias("q"))
    return best.select("doc_id", F.when(F.col("q") == 1, GOOD).when(F.col("q") == 0, POOR).otherwise(UNKNOWN).alias("weight"))


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` with all their columns, each as often as the mix takes it; a document without words never is."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"),
                        text_tag(F.col("text")).alias("tag"))
    found = mix(sized, label_weights(labels), whole=True)
    copies = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0))
    return with_count(docs, text_tag(F.col("text")), found.select("doc_id", "tag", copies.alias("copies")))


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with the words that the mix takes from each; quality weights come from ``labels``."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))
    out = mix(docs, label_weights(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", "taken")
