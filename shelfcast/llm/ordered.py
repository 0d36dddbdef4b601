"""Rows in a global order with a look at the neighbours, without gathering them.

Rows are cut into key ranges; each range is one task.  The first (and, when
asked for, last) row of a range is copied into the neighbouring range as an
edge row, so every row meets its neighbours inside its own task.  Only the
range limits reach the driver, two keys per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common as C

BEFORE, OWN, AFTER = 0, 1, 2


def with_neighbours(df: DataFrame, keys: list[str], parts: int, cyclic: bool = False, both: bool = False) -> DataFrame:
    """``df`` sorted by ``keys`` inside range partitions, with ``_side``: OWN rows, AFTER (and BEFORE) edge copies.

    ``keys`` must order the rows fully (rows equal in all keys are taken as
    identical).  ``cyclic`` puts the first row of all after the last.
    """
    points = C.split_points(df, keys[:-1] or keys, parts)
    ranged = df.withColumn("_range", C.range_bucket(df, points, keys[:-1] or keys))
    key = F.struct(*keys)
    limits = ranged.groupBy("_range").agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("_range").collect()
    low, high = {}, {}
    for i, row in enumerate(limits):
        if i or cyclic:
            low[tuple(row["low"])] = limits[i - 1]["_range"]
        if both and i + 1 < len(limits):
            high[tuple(row["high"])] = limits[i + 1]["_range"]

    @F.pandas_udf("array<struct<r: int, side: int>>")
    def places(own, nulls, *cols):
        import pandas as pd

        out = []
        for r, null, *key in zip(own.tolist(), nulls.tolist(), *[c.tolist() for c in cols], strict=True):
            key = tuple(None if gone else v for gone, v in zip(null, key, strict=True))
            spots = [{"r": r, "side": OWN}]
            if key in low:
                spots.append({"r": low[key], "side": AFTER})
            if key in high:
                spots.append({"r": high[key], "side": BEFORE})
            out.append(spots)
        return pd.Series(out)

    gone = F.array(*[F.col(k).isNull() for k in keys])
    placed = places("_range", gone, *C.plain_keys(df, keys)[:-1])
    n = max((row["_range"] for row in limits), default=0) + 1
    spread = (ranged.withColumn("_place", F.explode(placed))
              .withColumn("_range", F.col("_place.r")).withColumn("_side", F.col("_place.side")).drop("_place"))
    return spread.repartitionById(n, F.col("_range")).sortWithinPartitions("_range", "_side", *keys)
