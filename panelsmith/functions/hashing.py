"""Deterministic, placement-independent row buckets.

The bucket of a row depends only on its key, never on partitioning or task
order, so splits and masks are stable under repartitioning and executor loss,
and the same number is computed by any SQL engine with md5:
``cast(conv(substr(md5(cast(k as string)),1,8),16,10) as bigint)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_text(keys: Sequence[str | Column]) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    if len(cols) == 1:
        return cols[0].cast("string")
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def md5_bucket(keys: str | Column | Sequence[str | Column], modulo: int, purpose: str = "", seed: int = 2026) -> Column:
    """First 32 bits of md5(key text) modulo ``modulo``. A ``purpose`` salts the
    text (with the seed), so that buckets for different purposes, such as a
    split and the folds inside it, do not depend on each other."""
    if isinstance(keys, (str, Column)):
        keys = [keys]
    text = F.concat(F.lit(f"{purpose}:{seed}:"), _key_text(keys)) if purpose else _key_text(keys)
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(modulo)).cast("int")


def split_label(keys, train_pct: int = 80, seed: int = 2026) -> Column:
    """'train' for buckets below ``train_pct`` of 100, else 'test'."""
    return F.when(md5_bucket(keys, 100, "split", seed) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def fold_of(keys, folds: int = 5, seed: int = 2026) -> Column:
    """Fold number 0..folds-1 for k-fold cross-validation."""
    return md5_bucket(keys, folds, "fold", seed)


def masked(value: str | Column, keys, modulo: int = 10, hit: int = 0) -> Column:
    """NULL where md5 bucket == hit, value elsewhere (a reproducible gap maker)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(md5_bucket(keys, modulo) != hit, v)
