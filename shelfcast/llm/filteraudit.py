"""How a chain of filters interacts: what each removes in every order of application.

Each text fails a set of filters, a bit mask.  The step at which an order removes
a mask is a min-plus product: the mask's row (0 where it fails, infinity where it
does not) combined by minimum with the order's positions, the inverse of its
permutation.  Masks and orders are as many as the filters allow (32 and 120 for
five), so this product is a constant table.  Rows are first counted per
(part, mask, label marks); the counts are then scattered over the product.

Filters (fixed by the operator's contract), words being maximal runs without
white space, case-sensitive:

* A fewer than 200 words
* B distinct words are fewer than half of the words
* C more than 3 % of the code points are A-Z
* D holds one of ``#$%&*|``
* E the same text stands under a smaller ``doc_id`` anywhere in the table

Defined results: a null text counts as empty; a null ``part`` is the empty string; a
row without ``doc_id`` never fails E, makes no other row fail it and has no labels;
rows that repeat an id and its text do not fail E by each other; an id with several
label rows counts as good (toxic) if one of them says so; an empty table has no
parts and so no rows.  Columns beside those named are ignored.

Copies of one text, however many, meet as counts: equal (text hash, id) rows are
summed before a hash is looked at as a whole, and that sum is combined map-side.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NEVER = 99


def text_failures(text: Column) -> Column:
    """Bits of A to D for one text."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, CAPITALS, ""))
    fails = [n < MIN_WORDS, 100 * distinct.cast("long") < 50 * n.cast("long"),
             100 * capitals.cast("long") > 3 * chars.cast("long"), text.rlike(r"[#$%&*|]")]
    mask = F.lit(0)
    for bit, failing in enumerate(fails):
        mask = mask + F.when(failing, 1 << bit).otherwise(0)
    return mask


def marked_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled id: is it good, is it toxic."""
    return (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.max((F.col("quality") == 1)).alias("_good"), F.max((F.col("toxic") == 1)).alias("_toxic")))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): rows per failure mask, E included; at most parts x 128 rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("_hash"), text_failures(text).alias("_mask"))
    same = rows.groupBy("_hash", "_id", "part").agg(F.count(F.lit(1)).alias("n"), F.first("_mask").alias("_mask"))
    # rows without an id have no label; kept out of the join so that they do not meet in one task
    marks = marked_labels(labels).withColumnRenamed("doc_id", "_id")
    known = same.where("_id IS NOT NULL").join(marks, "_id", "left")
    nothing = same.where("_id IS NULL").withColumn("_good", F.lit(None).cast("boolean")).withColumn("_toxic", F.lit(None).cast("boolean"))
    marked = known.unionByName(nothing).select(
        "_hash", "_id", "part", "_mask", "n", F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"))
    # per text and group: all rows, those without an id, and the smallest id with its rows
    groups = marked.groupBy("_hash", "part", "good", "toxic").agg(
        F.first("_mask").alias("_mask"), F.sum("n").alias("n"), F.sum(F.when(F.col("_id").isNull(), F.col("n")).otherwise(0)).alias("_free"),
        F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "n"))).alias("_least"))
    smallest = groups.groupBy("_hash").agg(F.min("_least._id").alias("_first"))
    copy = 1 << FILTERS.index("E")
    free = F.col("_free") + F.when(F.col("_least._id") == F.col("_first"), F.col("_least.n")).otherwise(0)
    split = groups.join(smallest, "_hash").select(
        "part", "good", "toxic", "_mask", F.explode(F.array(
            F.struct(F.lit(0).alias("e"), free.alias("n")), F.struct(F.lit(copy).alias("e"), (F.col("n") - free).alias("n")))).alias("_x"))
    return (split.where("_x.n > 0").groupBy("part", (F.col("_mask") + F.col("_x.e")).alias("mask"), "good", "toxic")
            .agg(F.sum("_x.n").cast("long").alias("n")))


def removal_steps(names: str = FILTERS) -> tuple[list[str], np.ndarray]:
    """(orders, steps): steps[order, mask] = the 1-based step that removes a mask, NEVER where none does."""
    k = len(names)
    orders = list(permutations(range(k)))
    position = np.argsort(np.array(orders), axis=1) + 1
    failing = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
    cost = np.where(failing == 1, 0, NEVER)
    steps = (position[:, None, :] + cost[None, :, :]).min(axis=2)
    return ["".join(names[i] for i in order) for order in orders], np.minimum(steps, NEVER)


def interaction_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    k = len(FILTERS)
    orders, steps = removal_steps()
    weights = mask_counts(docs, labels, part)
    # a constant of orders x masks rows, whatever the input
    ranks = spark.createDataFrame(
        [(m, o, int(steps[o, m])) for o in range(len(orders)) for m in range(1 << k)], "mask int, _order int, _gone int")
    places = [(o, order, s + 1, 1 << FILTERS.index(order[s])) for o, order in enumerate(orders) for s in range(k)]
    grid = spark.createDataFrame(places, "_order int, filter_order string, step int, _bit int")
    plan = F.broadcast(ranks.join(F.broadcast(grid), "_order").select(
        "mask", "filter_order", "step", "_gone", "_bit", F.col("mask").bitwiseAND(F.col("_bit")).alias("_fails")))
    n, here = F.col("n"), F.col("_gone") == F.col("step")

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).cast("long")

    cells = weights.join(plan, "mask").groupBy("part", "filter_order", "step", "_bit").agg(
        count(F.col("_gone") > F.col("step")).alias("kept"), count(here).alias("removed"),
        count((F.col("_fails") > 0) & (F.col("_gone") < F.col("step"))).alias("redundant"),
        count(F.col("mask") == F.col("_bit")).alias("unique_fails"),
        count(here & F.col("good")).alias("good_lost"), count(here & F.col("toxic")).alias("toxic_lost"))
    credit = cells.groupBy("part", "_bit").agg(F.sum("removed").cast("long").alias("shapley"))
    return cells.join(credit, ["part", "_bit"]).drop("_bit")
