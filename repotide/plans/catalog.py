"""Every query by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repotide.plans import batch, decoding, streams
from repotide.plans.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {**batch.QUERIES, **decoding.QUERIES, **streams.QUERIES}

__all__ = ["ORACLE", "QUERIES", "Query"]
