"""Partition key of an identifier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_key(identifier: Column) -> Column:
    short = F.translate(F.substring(F.lower(identifier), 1, 4), "/", "_")
    return F.when(identifier.like("10.%/%"), F.lower(F.substring_index(identifier, "/", 1))).otherwise(short)
