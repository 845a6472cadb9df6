"""Merging a new delivery into an existing table by null-safe keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.operators.sets import bind_rows
from limnos.schema import MERGE_KEYS


def amalgamate(new: DataFrame, existing: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Rows of new, and those of existing whose keys new doesn't have; columns of both, nulls where one lacks them.

    Null keys are equal. Both frames should have each key once: see counts_agree.
    """
    have = new.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
    on = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    return bind_rows(new, existing.join(have, on, "left_anti"))


def overlap_counts(new: DataFrame, existing: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """One row: n_both, the keys that both have, and n_identity, what the sizes of both and of their union make it.

    One aggregation by key of both frames instead of an intersection, two distincts and a union.
    """
    a = new.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b"))
    b = existing.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    each = a.unionByName(b).groupBy(*keys).agg(F.max("__a").alias("a"), F.max("__b").alias("b"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return each.agg(n(F.col("a") * F.col("b")).alias("n_both"), (n(F.col("a")) + n(F.col("b")) - F.count("*")).alias("n_identity"))


def counts_agree(new: DataFrame, existing: DataFrame, merged: DataFrame, keys: list[str] = MERGE_KEYS) -> bool:
    """Whether |merged| = |new| + |existing| - |keys that both have|, which fails if either repeats a key."""
    n = overlap_counts(new, existing, keys).first()
    return merged.count() == new.count() + existing.count() - n["n_both"]
