"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import scratch_path

# Rows per Arrow batch handed to Python: bounds a worker's memory when texts are long.
ARROW_ROWS = 1000
PACKAGE = "shelfcast-package.zip"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts (a memory setting, not a result setting), and this package on the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if PACKAGE not in getattr(sc, "_python_includes", []):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(tempfile.mkdtemp(prefix="shelfcast-code-"), PACKAGE)
        with zipfile.ZipFile(target, "w") as z:
            for sub, _, names in os.walk(os.path.join(root, "shelfcast")):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(sub, name)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(target)


def persisted(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet under the cluster-shared folder and read back.

    Cuts lineage: a lost executor re-reads the table instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of phases whose result is already written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def arrow_type(dt: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(dt)


def with_fields(df: DataFrame, extra: list[T.StructField]) -> T.StructType:
    """Schema of ``df`` plus ``extra``; an input column of the same name gives way."""
    new = {f.name.lower() for f in extra}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in new] + extra)


def append_columns(batch: pa.RecordBatch, schema: T.StructType, values: dict[str, list]) -> pa.RecordBatch:
    """The batch under ``schema`` with the computed ``values`` in place of its own."""
    arrays, names = [], []
    for f in schema.fields:
        names.append(f.name)
        if f.name in values:
            arrays.append(pa.array(values[f.name], type=arrow_type(f.dataType)))
        else:
            arrays.append(batch.column(batch.schema.get_field_index(f.name)))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def text_runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit`` (one item at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def split_points(df: DataFrame, keys: list[str], parts: int, seed: int = 7) -> list[tuple]:
    """At most ``parts - 1`` ascending key tuples cutting ``df`` into even ranges.

    Keys are sampled (some 200 per range); the points only steer balance, every
    row is placed whatever they are.  What reaches the driver is bounded by ``parts``.
    """
    if parts <= 1:
        return []
    narrow = df.select(*keys).dropna()
    n = narrow.count()
    want = 200 * parts
    rows = narrow.sample(False, min(1.0, want / max(n, 1)), seed).limit(2 * want).collect() if n else []
    rows = sorted({tuple(r) for r in rows})
    picks = [rows[len(rows) * i // parts] for i in range(1, parts)] if rows else []
    return sorted(set(picks))


def plain_keys(df: DataFrame, keys: list[str]) -> list:
    """Key columns with nulls filled (so that pandas keeps integers) and, last, whether any was null."""
    fill = {f.name: "" if isinstance(f.dataType, T.StringType) else 0 for f in df.schema.fields}
    some = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return [*[F.coalesce(F.col(k), F.lit(fill[k])) for k in keys], some]


def range_bucket(df: DataFrame, points: list[tuple], keys: list[str]):
    """Column: number of split points at or below the row's key (rows with a null key: 0)."""
    if not points:
        return F.lit(0)

    @F.pandas_udf("int")
    def bucket(*cols):
        import bisect

        import pandas as pd

        *values, some = [c.tolist() for c in cols]
        return pd.Series([0 if null else bisect.bisect_right(points, key)
                          for null, key in zip(some, zip(*values, strict=True), strict=True)], dtype="int32")

    return bucket(*plain_keys(df, keys))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------------------- rolling hashes over bytes

_B = 0x9E3779B97F4A7C15 | 1
KEPT_POWERS = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:1] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            step = min(done, n - done)
            out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
    return out


class PrefixHash:
    """Hashes of arbitrary byte ranges of one buffer, vectorised (polynomial modulo 2^64, then mixed).

    Equal ranges hash equally whatever their place.  Used to find candidates;
    callers that must be exact compare the bytes (or a wide digest) afterwards.
    """

    _table = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
    _pow = np.ones(1, dtype=np.uint64)
    _inv = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        cls = PrefixHash
        if len(cls._pow) < n + 1 <= KEPT_POWERS:
            size = 1 << (n + 1).bit_length()
            cls._pow, cls._inv = _powers(_B, size), _powers(pow(_B, -1, 1 << 64), size)
        # long buffers get powers of their own, a worker keeps only small tables
        kept = n + 1 <= KEPT_POWERS
        power = cls._pow if kept else _powers(_B, n + 1)
        self.inverse = cls._inv if kept else _powers(pow(_B, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(cls._table[data] * power[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix64((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
