"""Mixing sources to target weights by hierarchical budgeting.

Sources form a tree: domain, language, source. The budget flows from the root: at each node it is shared among the children by
weight; a child that holds less than its share gives the shortage back, and its siblings take it by their weights (water-filling);
only what all of them can't take stays with the parent, whose siblings then take it. As a node's capacity is the sum of its
leaves', one pass down the tree does this. Shares are whole tokens, rounded down.

A leaf's budget is then filled from seeded epochs: in epoch e its documents stand in the order of a hash of (seed, e, doc_id), and the
prefix whose tokens before each document stay below the budget is taken; up to ``max_epochs`` epochs. All epochs before the last are
whole, so only the last needs the prefix. It is found without gathering a leaf in one task: tokens are summed by (leaf, hash
bucket), running sums over buckets give each bucket's start, and only inside the one bucket of a leaf where the budget ends are documents
sorted. A leaf with a third of all rows is so spread over its buckets.

All arithmetic is on integers, so the result doesn't depend on partitioning.

Defined cases: a null or empty text has no tokens, and is taken if its place in the prefix is; a null source or language is a
leaf of its own; ties of the hash are broken by doc_id; repeated rows of a document are rows each; weights that aren't given are
``default_weight``; a weight of 0 gets nothing, and weights are at most 10**9; rows without an id are taken or left together, as one id, by ``mixed_documents``;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_CLASS, Scratch

BUCKETS = 4096
LEVELS = ["domain", "lang", "source"]


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """The default grouping of sources: by the parity of the number in the name; names without a number are a domain of their own."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)$", 1)
    return F.when(number == "", F.lit("other")).when(F.substring(number, -1, 1).isin("0", "2", "4", "6", "8"), F.lit("even")).otherwise(F.lit("odd"))


def _weight(level: str, weights: dict[str, dict[str, int]], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, w).otherwise(out)
    return out.cast("long")


def allocate(leaves: DataFrame, budget: Column, weights: dict[str, dict[str, int]], *, default_weight: int = 1, levels: list[str] = LEVELS) -> DataFrame:
    """Adds ``budget`` to ``leaves(*levels, capacity)``. The windows run over siblings in the tree of sources, not over documents."""
    out = leaves.withColumn("_budget", budget)
    for depth, level in enumerate(levels):
        above, here = levels[:depth], levels[: depth + 1]
        nodes = out.groupBy(*here).agg(F.sum("capacity").alias("c"), F.first("_budget").alias("b")).withColumn("w", _weight(level, weights, default_weight))
        by = Window.partitionBy(*(F.coalesce(F.col(x), F.lit("\0")) for x in above)) if above else Window.partitionBy(F.lit(0))
        # Children in order of capacity per weight: each is full, or gets its share of what the ones before it have left.
        # The ratio as a whole number and 18 places, which tells fractions of denominators up to 10**9 apart.
        nodes = nodes.withColumn("_ratio", F.expr("case when w > 0 then named_struct('a', c div w, 'b', cast(c % w as decimal(38,0)) * 1000000000000000000 div w) end"))
        rank = by.orderBy(F.col("_ratio").asc_nulls_last(), F.col(level))
        before = rank.rowsBetween(Window.unboundedPreceding, -1)
        nodes = nodes.withColumn("_left", F.col("b") - F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("_w", F.sum("w").over(by) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        full = F.expr("w > 0 and cast(c as decimal(38,0)) * _w <= cast(_left as decimal(38,0)) * w")
        # The first child that isn't full fixes the level for all after it.
        nodes = nodes.withColumn("_full", full).withColumn("_stop", F.min(F.when(~F.col("_full") & (F.col("w") > 0), F.struct("_ratio", F.col(level), "_left", "_w"))).over(by))
        share = F.expr("case when _full then c when w = 0 then 0 else least(c, cast(cast(greatest(_stop._left, 0) as decimal(38,0)) * w div _stop._w as bigint)) end")
        shared = nodes.select(*(F.col(x).alias(f"_{x}") for x in here), share.alias("_next"))
        same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in here]
        out = out.join(shared, same).drop("_budget", *(f"_{x}" for x in here)).withColumnRenamed("_next", "_budget")
    return out.withColumnRenamed("_budget", "budget")


def mix(spark: SparkSession, docs: DataFrame, *, share_permille: int, weights: dict[str, dict[str, int]], seed: int, max_epochs: int = 1, default_weight: int = 1) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, copies``: the documents taken, with the number of epochs that take each.

    The budget is ``share_permille`` thousandths of all tokens.
    """
    scratch = Scratch(spark, "mix")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", domain_of(F.col("source")).alias("domain"), token_count(F.col("text")).alias("n_tokens"))
    rows = scratch.save(rows, "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).withColumn("capacity", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = allocate(leaves, F.lit(total * share_permille // 1000).cast("long"), weights, default_weight=default_weight)
    plan = scratch.save(plan.withColumn("whole", F.when(F.col("tokens") > 0, F.least(F.expr("budget div tokens"), F.lit(max_epochs))).otherwise(F.lit(0)).cast("int")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")), "plan")
    named = plan.select(*(F.col(x).alias(f"_{x}") for x in LEVELS), "whole", "rest", "budget")
    taken = rows.join(named, [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in LEVELS]).drop(*(f"_{x}" for x in LEVELS))
    # The order within the last epoch: the top 12 of 60 bits of the hash are the bucket.
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("whole"), F.col("doc_id")).cast("binary")), 1, 15), 16, 10).cast("long")
    taken = taken.withColumn("_h", order).withColumn("_bucket", F.shiftright("_h", 48).cast("int"))
    sums = taken.groupBy(*LEVELS, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    leaf = [F.coalesce(F.col(x), F.lit("\0")) for x in LEVELS]
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = starts.select(*(F.col(x).alias(f"_{x}") for x in LEVELS), F.col("_bucket").alias("_b"), "_start", "_sum")
    spread = taken.join(starts, [*(F.col(x).eqNullSafe(F.col(f"_{x}")) for x in LEVELS), F.col("_bucket") == F.col("_b")]).drop(*(f"_{x}" for x in LEVELS), "_b")
    whole = spread.where("_start + _sum < rest").withColumn("_in", F.lit(True))
    none = spread.where("_start >= rest").withColumn("_in", F.lit(False))
    inside = Window.partitionBy(*leaf, "_bucket").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = spread.where("_start + _sum >= rest and _start < rest").withColumn("_in", F.col("_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)) < F.col("rest"))
    out = whole.unionByName(edge).unionByName(none).withColumn("copies", F.col("whole") + F.col("_in").cast("int"))
    return out.where("copies > 0").select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The documents that a mix takes in at least one epoch, with all their columns."""
    taken = mix(spark, docs, **options).select(F.col("doc_id").alias("_taken"))
    return docs.join(taken, docs.doc_id.cast("long").eqNullSafe(taken._taken), "left_semi")
