"""Joins to a value per key, where a few keys may hold most of the left rows.

One plan at every size: an equi-join on the key. The left side is never grouped, so adaptive
execution may split a partition that one key fills and copy the few rows of the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.functions.names import quoted_name


def join_per_key(left: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left rows with the other columns of ``per_key``, which has one row per key (NULL is a key);
    a left row without one gets NULL."""
    added = [c for c in per_key.columns if c != key]
    side = per_key.select(F.col(quoted_name(key)).alias("__key"), *[F.col(quoted_name(c)).alias(f"__{c}") for c in added])
    joined = left.join(side, left[quoted_name(key)].eqNullSafe(F.col("__key")), "left")
    return joined.select(*[left[quoted_name(c)] for c in left.columns], *[F.col(quoted_name(f"__{c}")).alias(c) for c in added])


def flag_members(left: DataFrame, members: DataFrame, key: str, member_key: str, name: str) -> DataFrame:
    """Add a boolean: is ``left[key]`` in ``members``? NULL is never a member."""
    known = members.select(F.col(member_key).alias("__m")).where("__m is not null").distinct()
    joined = left.join(known, left[quoted_name(key)] == F.col("__m"), "left")
    return joined.select(*[left[quoted_name(c)] for c in left.columns], F.col("__m").isNotNull().alias(name))
