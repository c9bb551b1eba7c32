"""Operators of a training-data pipeline over documents and embeddings."""

from __future__ import annotations

from repotide.llm.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
