"""Mixing sources to target weights by hierarchical budgets (DataFrame operations only).

Every document belongs to a leaf of a tree (by default domain, language,
source). A token budget flows down the tree: the children of a node share its
budget by their weights, but none gets more than its subtree can give
(``max_epochs`` passes over its tokens). What a child can't use goes to its
siblings by their weights, again up to what they can give; only what a whole
subtree can't use has gone to that subtree's siblings, one level up. So a
shortage is met by siblings before it reaches relatives of an ancestor.

All budgets are whole tokens. Within a set of siblings, sorted by capacity per
weight, those that are filled come first; running sums tell which they are, so
no iteration is needed and both sums are exact (decimals).

A leaf's budget is spent on whole passes (epochs) over its documents and then
on a prefix of one more pass, in an order seeded by the epoch; the document
at the end of the prefix is cut to the tokens that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paysift.llm.store import table

#: Documents per bucket of a leaf's order: one bucket is sorted in one task.
BUCKET_ROWS = 4096
#: Parts of a leaf that meet its budget in separate tasks.
SLICES = 256
NONE = "(none)"


def count_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def leaf_budgets(leaves: DataFrame, levels: list[tuple[str, Column]], total: int | None, max_epochs: int) -> DataFrame:
    """``leaves`` (one column per level, tokens) with the column ``budget``.

    ``levels`` names the level columns from the root down, each with the weight
    (a whole number; null, zero or negative: nothing) of its nodes, an
    expression over the columns of its path. ``total`` None: all tokens once.
    """
    names = [n for n, _ in levels]
    big = lambda c: F.col(c).cast("decimal(19,0)")
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    parents = nodes.agg(F.coalesce(F.sum("cap"), F.lit(0)).cast("long").alias("cap"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("once"))
    parents = parents.select(F.least("cap", F.lit(total).cast("long") if total is not None else F.col("once")).alias("budget"))
    for i, (_, weight) in enumerate(levels):
        path, above = names[: i + 1], names[:i]
        level = nodes.groupBy(*path).agg(F.sum("cap").cast("long").alias("cap")).withColumn("w", weight.cast("long")).where("w > 0 and cap > 0")
        level = level.join(parents, above) if above else level.crossJoin(F.broadcast(parents))  # the root is one row
        by = W.partitionBy(*above) if above else W.partitionBy(F.lit(0))
        order = by.orderBy(F.col("cap") / F.col("w"), names[i])
        # a row is filled if its capacity is at most its share of what the filled rows before it have left
        level = level.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        level = level.withColumn("w_rest", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
        level = level.withColumn("full", big("cap") * big("w_rest") <= (big("budget") - big("before")) * big("w"))
        level = level.withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0)))
        level = level.withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w"))).over(by))
        share = F.expr("cast(cast(left as decimal(20,0)) * cast(w as decimal(18,0)) div cast(w_open as decimal(20,0)) as long)")
        parents = level.select(*path, F.when(F.col("full"), F.col("cap")).otherwise(share).alias("budget"))
    return leaves.join(parents, names, "left").withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))


def mix(docs: DataFrame, levels: list[tuple[str, Column, Column]], total: int | None = None, max_epochs: int = 4, seed: int = 0) -> DataFrame:
    """(doc_id, one column per level, epoch, n_tokens, take_tokens): what to train on.

    ``levels``: (name, value of a document, weight of a node over the names so
    far). A null value is the branch '(none)'. One row is one pass (epoch, from
    0) of one document, of which the first ``take_tokens`` tokens are taken:
    all but for at most one document of a leaf. Documents without tokens (null
    or blank text) are not selected. Repeated rows are documents of their own;
    rows that agree in doc_id and tokens are interchangeable. An empty table,
    or one whose weights are all zero, gives no rows. Budgets are floored to
    whole tokens, so up to one token per node is left unspent. Other columns of
    ``docs`` are ignored, whatever they are called.
    """
    names = [n for n, _, _ in levels]
    values = [F.coalesce(value.cast("string"), F.lit(NONE)).alias(n) for n, value, _ in levels]
    counted = table(docs.select("doc_id", *values, count_tokens(F.col("text")).alias("n_tokens")).where("n_tokens > 0"))
    # a leaf's documents are dealt to slices, so that a leaf with a third of them doesn't meet its budget in one task
    counted = counted.withColumn("slice", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SLICES)))
    slices = counted.groupBy(*names, "slice").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    leaves = slices.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.sum("n_docs").alias("n_docs"))
    leaves = leaf_budgets(leaves, [(n, w) for n, _, w in levels], total, max_epochs).where("budget > 0")
    leaves = leaves.withColumn("passes", F.expr("budget div tokens")).withColumn("rest", F.expr("budget - (budget div tokens) * tokens"))
    leaves = leaves.select(*names, "passes", "rest", F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long").alias("buckets"))

    budgets = table(slices.select(*names, "slice").join(leaves, names))
    rows = counted.join(budgets, [*names, "slice"])
    # the order of the cut pass: by digest, in buckets that follow the digest
    rows = rows.withColumn("h", F.md5(F.concat_ws(":", F.lit(seed), "passes", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    rows = rows.withColumn("bucket", F.expr("shiftright(cast(conv(substr(h, 1, 8), 16, 10) as long) * buckets, 32)"))
    whole = rows.where("passes > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, passes - 1)"))).withColumn("take_tokens", F.col("n_tokens"))

    part = rows.where("rest > 0")
    sums = part.groupBy(*names, "bucket", "rest").agg(F.sum("n_tokens").alias("s"))
    sums = sums.withColumn("before", F.sum("s").over(W.partitionBy(*names).orderBy("bucket")) - F.col("s"))
    part = part.join(sums.where("before < rest").select(*names, "bucket", "before", "s"), [*names, "bucket"])
    inside = part.where("before + s <= rest").withColumn("take_tokens", F.col("n_tokens"))
    # the one bucket of a leaf where the prefix ends
    order = W.partitionBy(*names, "bucket").orderBy("h", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)
    last = part.where("before + s > rest").withColumn("upto", F.sum("n_tokens").over(order) + F.col("before"))
    last = last.withColumn("take_tokens", F.least(F.col("n_tokens"), F.col("rest") - F.col("upto") + F.col("n_tokens"))).where("take_tokens > 0")

    out = ["doc_id", *names, "epoch", "n_tokens", "take_tokens"]
    partial = inside.unionByName(last.drop("upto")).withColumn("epoch", F.col("passes"))
    return whole.select(*out).unionByName(partial.select(*out))
