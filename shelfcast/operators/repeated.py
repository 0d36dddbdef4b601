"""Keep-last over rows that mostly come once: only repeated keys are grouped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hashes of repeated keys the driver looks at; where more repeat, they are marked in bitmaps.
FEW_REPEATED = 1000
# A mark is one of so many bits (32 MB in all), picked by the key's hash.  Where more than half
# of them are set the bitmaps say too little.
MARK_BITS = 1 << 28


def repeated_keys(rows: DataFrame, keys: list[str]) -> list[int] | None:
    """Hashes of the ``keys`` that occur more than once in ``rows``; None where they are many.

    Reads the key columns only and shuffles eight bytes a row.  Two keys of one hash
    count as repeated, which costs a comparison and drops nothing.  The hashes are gathered
    by an aggregate: collecting behind a limit looks at one partition, then at four, and so on.
    """
    return _few(_repeated_hashes(rows, keys))


def _repeated_hashes(rows: DataFrame, keys: list[str]) -> DataFrame:
    hashes = rows.select(F.xxhash64(*keys).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    return hashes.where("_n > 1").select("_h")


def _few(hashes: DataFrame) -> list[int] | None:
    found = hashes.limit(FEW_REPEATED + 1).agg(F.collect_list("_h").alias("_hs")).first()["_hs"]
    return None if len(found) > FEW_REPEATED else found


def marked(hashes: DataFrame) -> DataFrame | None:
    """Bitmaps of the ``_h`` in ``hashes``, 32,768 marks a row as an array of words; None where they would be too full.

    What is marked may share its bit with other hashes: ``may_be_marked`` finds all of the
    ``hashes`` and some more, so it narrows rows down for an exact step and never decides.
    The bitmaps are computed here, once, and go to the tasks as a broadcast.
    """
    bit = F.pmod(F.col("_h"), F.lit(MARK_BITS))
    placed = hashes.select(F.shiftright(bit, 6).alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(_h, {MARK_BITS}) % 64 as int))").alias("_set"))
    words = placed.unionByName(hashes.sparkSession.range(MARK_BITS // 64).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_set")))
    # dealt out once, by bitmap
    whole = words.withColumn("_block", F.shiftright("_word", 9)).repartition("_block").groupBy("_block", "_word").agg(F.bit_or("_set").alias("_set"))
    in_order = F.sort_array(F.collect_list(F.struct("_word", "_set")))
    bitmaps = whole.groupBy("_block").agg(in_order.alias("_words")).select("_block", F.col("_words._set").alias("_bits")).localCheckpoint()
    set_bits = bitmaps.select(F.explode("_bits").alias("_set")).agg(F.sum(F.bit_count("_set"))).first()[0]
    return bitmaps if set_bits <= MARK_BITS // 2 else None


def may_be_marked(rows: DataFrame, keys: list[str], bitmaps: DataFrame, marked: bool = True) -> DataFrame:
    """The ``rows`` whose ``keys`` may be among the marked ones, or those that are certainly not.

    A semi or anti join, which Spark moves below projections, so texts are not built for rows it drops."""
    hashed = F.pmod(F.xxhash64(*keys), F.lit(MARK_BITS))
    word = F.get("_bits", (F.shiftright(hashed, 6) % 512).cast("int"))
    held = (F.shiftright(hashed, 15) == F.col("_block")) & (F.getbit(word, (hashed % 64).cast("int")) == 1)
    return rows.join(F.broadcast(bitmaps), held, "left_semi" if marked else "left_anti")


def keep_last_where_repeated(rows: DataFrame, keys: list[str], repeated: list[int] | DataFrame | None,
                             keep_last: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep_last(rows)``, grouping only rows whose key is among the ``repeated``: their hashes, or
    bitmaps that mark them (None: all rows)."""
    if repeated is None:
        return keep_last(rows)
    if repeated == []:
        return rows
    once, again = split_by_repeated(rows, keys, repeated)
    return once.unionByName(keep_last(again))


def split_by_repeated(rows: DataFrame, keys: list[str], repeated: list[int] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ``rows`` whose key certainly comes once, and the others."""
    if isinstance(repeated, DataFrame):
        return may_be_marked(rows, keys, repeated, False), may_be_marked(rows, keys, repeated)
    again = F.xxhash64(*keys).isin(repeated)
    return rows.where(~again), rows.where(again)


def repeated_or_marked(rows: DataFrame, keys: list[str]) -> list[int] | DataFrame | None:
    """``repeated_keys``; where they are many, bitmaps that mark them; None where even those would be too full."""
    hashes = _repeated_hashes(rows, keys).persist()
    try:
        return few_or_marked(hashes)
    finally:
        hashes.unpersist()


def few_or_marked(hashes: DataFrame) -> list[int] | DataFrame | None:
    """The ``_h`` in ``hashes`` where they are few, else bitmaps that mark them, None where those would be too full."""
    few = _few(hashes)
    return marked(hashes) if few is None else few
