"""Reproducible buckets from names, equal on every engine that has MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_number(*columns: Column) -> Column:
    """First 32 bits of the MD5 of the joined text, as a bigint."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def stable_bucket(buckets: int, *columns: Column) -> Column:
    """Bucket 0..buckets-1; does not depend on partitioning or process."""
    return F.pmod(hash_number(*columns), F.lit(buckets))


def name_jitter(name: Column, step: float = 0.005) -> Column:
    """Offset in [-50, 49] steps that keeps points of one centroid apart."""
    return (stable_bucket(100, name) - 50) * F.lit(step)
