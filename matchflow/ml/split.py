"""Splitting a table for training and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_share(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone and spreads evenly."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def split_by_key(df: DataFrame, key: str, evaluation: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows; all rows of one key fall on the same side."""
    held_out = key_share(F.col(key)) < evaluation
    return df.filter(~held_out), df.filter(held_out)


def split_rows(df: DataFrame, evaluation: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Row-wise random split; rows of one match may fall on both sides."""
    train, test = df.randomSplit([1 - evaluation, evaluation], seed)
    return train, test
