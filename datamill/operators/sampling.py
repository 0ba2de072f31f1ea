"""Samples, splits and unions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.functions.buckets import bucket, share
from datamill.session import persisted

Result = TypeVar("Result")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep each row with probability `fraction`, without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: Column, fraction: float, salt: str = "sample") -> DataFrame:
    """Keep the rows whose key hashes below `fraction`: the same rows on every run, also
    when a lost task is run again."""
    return df.filter(bucket(key, salt) < share(fraction))


def with_split(df: DataFrame, key: Column, weights: Sequence[float], salt: str = "split") -> DataFrame:
    """Add `split`, the number of the part that the key's hash falls in."""
    value = bucket(key, salt)
    reached, part = 0.0, F.lit(len(weights) - 1)
    bounds = []
    for weight in weights[:-1]:
        reached += weight / sum(weights)
        bounds.append(share(reached))
    for number, bound in reversed(list(enumerate(bounds))):
        part = F.when(value < bound, F.lit(number)).otherwise(part)
    return df.withColumn("split", part.cast("int"))


def hash_split(df: DataFrame, key: Column, weights: Sequence[float], salt: str = "split") -> list[DataFrame]:
    """Split rows by the hash of a key into parts of the given weights."""
    tagged = with_split(df, key, weights, salt)
    return [tagged.filter(F.col("split") == number).drop("split") for number in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both inputs with repeats kept, columns matched by name."""
    return first.unionByName(second)


def on_splits(
    df: DataFrame,
    key: Column,
    body: Callable[[DataFrame, DataFrame, DataFrame], Result],
    weights: Sequence[float] = (0.8, 0.1, 0.1),
) -> Result:
    """Call `body` with kept training, validation and test parts and release them after."""
    with persisted(*hash_split(df, key, weights)) as (train, validation, test):
        return body(train, validation, test)
