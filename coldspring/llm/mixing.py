"""Mixing sources to target weights. DataFrame operations only.

Documents get a hash-random key, are range-sorted by it within their source, and distributed prefix
sums of their sizes place each document on the source's word axis. A source's budget is cut on that
axis exactly; a budget above the source's size goes round the axis again (another epoch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring.llm import ordered
from coldspring.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, workspace: Workspace, weights=(5, 2, 1), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """(_source, _target): sources in code point order, nulls last, weigh ``weights`` in turn and share ``share`` times
    all words. No target exceeds ``repeats`` times its source; the excess goes to the others by weight.

    Sources fill up in the order of capacity per weight, so who is full follows from running sums
    in that order: the source is full if the budget still covers everyone at its level.
    """
    per_source = sizes.groupBy("_source").agg(F.sum("_size").alias("_words"))
    ranked = ordered.cut(per_source.withColumn("_one", F.lit(1)), workspace, ["_source"], "mix-sources")
    ranked = ordered.running_sums(ranked, [], ["_source"], {"_rank": "_one"})
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    capacity = (F.col("_words") * repeats).cast("double")
    filled = ranked.select("_source", "_words", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("_weight"),
                           capacity.alias("_cap"))
    filled = filled.withColumn("_level", F.col("_cap") / F.col("_weight"))
    filled = ordered.cut(filled, workspace, ["_level", "_source"], "mix-levels")
    filled = ordered.running_sums(filled, [], ["_level", "_source"], {"_cap_before": "_cap", "_weight_before": "_weight"})
    total, all_weights = filled.agg(F.sum("_words"), F.sum("_weight")).first()
    budget, all_weights = share * (total or 0), all_weights or 0.0
    full = F.col("_cap_before") + F.col("_level") * (F.lit(all_weights) - F.col("_weight_before")) <= budget
    filled = filled.withColumn("_full", full)
    taken, weight = filled.filter("_full").agg(F.sum("_cap"), F.sum("_weight")).first()
    left = all_weights - (weight or 0.0)
    level = (budget - (taken or 0.0)) / left if left > 0 else 0.0
    return filled.select("_source", F.when(F.col("_full"), F.col("_cap")).otherwise(F.lit(level) * F.col("_weight")).alias("_target"))


def mix_sources(docs: DataFrame, workspace: Workspace, weights=(5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row (id, source, size, source_size, target, taken) per row of ``docs``.

    size: words of the text (null: 0). taken: words that the mix takes of the document, repeats counted; at most
    ``repeats`` times its size. The taken words of a source add up to its target, rounded down: the
    document at the cut gives part of its words. Documents of a source are taken in the order of
    md5(seed:id), so the same rows always give the same mix; rows with equal ids follow by size.

    A null source is a source of its own; null ids are allowed; words never split a source of size 0. Only the
    three named columns are read. An empty table gives an empty table.
    """
    # The group key is never null: "0" + source, or "1", which sorts after all of them.
    key = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sizes = docs.select(F.col(id_col).alias("_id"), key.alias("_source"), F.col(source_col).alias("_name"), draw.alias("_draw"),
                        word_count(F.col(text_col)).alias("_size"))
    order = ["_draw", "_size"]
    sizes = ordered.cut(sizes, workspace, ["_source", *order], "mix-documents")
    placed = ordered.running_sums(sizes, ["_source"], order, {"_before": "_size"})
    targets = source_targets(sizes, workspace, weights, share, repeats)
    budget = F.floor("_target")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("_size"), budget - e * F.col("_before_all") - F.col("_before")))
                 for e in range(1, repeats)), F.greatest(F.lit(0), F.least(F.col("_size"), budget - F.col("_before"))))
    return (placed.join(targets, "_source")
            .select(F.col("_id").alias(id_col), F.col("_name").alias(source_col), F.col("_size").alias("size"),
                    F.col("_before_all").alias("source_size"), F.col("_target").alias("target"), taken.cast("long").alias("taken")))
