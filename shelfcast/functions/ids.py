"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_ingest_id(topic: Column, partition: Column, offset: Column) -> Column:
    """sha256 hex of ``topic:partition:offset``: one id per Kafka coordinate."""
    return F.sha2(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string")), 256)
