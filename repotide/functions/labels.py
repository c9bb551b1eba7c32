"""Label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case language to bucket; everything else falls into REST_BUCKET.
BUCKETS = {"python": "Python", "java": "Java"}
REST_BUCKET = "C"


def language_bucket(
    language: Column, buckets: Mapping[str, str] = BUCKETS, rest: str = REST_BUCKET
) -> Column:
    """Bucket of a language, ignoring case; unknown and missing languages go to ``rest``."""
    folded = F.lower(language)
    label = F.lit(rest)
    for name, bucket in buckets.items():
        label = F.when(folded == name, bucket).otherwise(label)
    return label
