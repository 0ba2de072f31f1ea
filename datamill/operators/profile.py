"""Column statistics with missing values, contrasts, scores and frequency tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.functions.numbers import or_zero, present


def parse_pair_scores(lines: DataFrame, scores: int, missing: str = "?") -> DataFrame:
    """Comma lines `id1,id2,score…,matched` to typed columns; the missing mark gives NULL.

    A line that does not fit fails the job.
    """
    fields = ["id1 bigint", "id2 bigint", *[f"s{i} double" for i in range(scores)], "matched boolean"]
    options = {"mode": "FAILFAST", "nullValue": missing}
    record = F.from_csv("value", ", ".join(fields), options)
    return lines.select(record.alias("r")).select("r.*")


def pair_record(parsed: DataFrame, scores: int) -> DataFrame:
    """The record form: ids, one array of scores, the match flag."""
    return parsed.select("id1", "id2", F.array(*[f"s{i}" for i in range(scores)]).alias("scores"), "matched")


def missing_stats(df: DataFrame, dims: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, population deviation, minimum, maximum and missing count per dimension.

    All dimensions come out of one aggregation over one scan; only the finished rows, one
    per group, are turned to long form.
    """
    packed = [
        F.struct(
            F.lit(name).alias("dim"),
            F.count(present(value)).alias("n"),
            F.avg(present(value)).alias("mean"),
            F.stddev_pop(present(value)).alias("stdev"),
            F.min(present(value)).alias("min"),
            F.max(present(value)).alias("max"),
            F.count_if(present(value).isNull()).alias("missing"),
        ).alias(name)
        for name, value in dims.items()
    ]
    wide = df.groupBy(*by).agg(*packed)
    return wide.select(*by, F.inline(F.array(*dims)))


def dim_stats(df: DataFrame, dims: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """`missing_stats` without the missing count."""
    return missing_stats(df, dims, by).drop("missing")


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, population deviation, minimum and maximum of one column."""
    return dim_stats(df, {column: F.col(column)})


def flag_contrast(df: DataFrame, dims: Mapping[str, Column], flag: str) -> DataFrame:
    """Per dimension: missing values on both sides together, and the mean where the flag
    holds minus the mean where it does not."""
    on, off = F.col(flag), ~F.col(flag)
    packed = [
        F.struct(
            F.lit(name).alias("dim"),
            F.count_if(present(value).isNull() & F.col(flag).isNotNull()).alias("missing"),
            (F.avg(F.when(on, present(value))) - F.avg(F.when(off, present(value)))).alias("mean_gap"),
        ).alias(name)
        for name, value in dims.items()
    ]
    return df.agg(*packed).select(F.inline(F.array(*dims)))


def total_score(dims: Sequence[Column]) -> Column:
    """Sum of the chosen dimensions with missing values taken as zero."""
    total = F.lit(0.0)
    for value in dims:
        total = total + or_zero(value)
    return total


def threshold_contingency(df: DataFrame, score: str, flag: str, thresholds: Sequence[float]) -> DataFrame:
    """How many rows of each flag value reach each threshold; zero counts are left out."""
    packed = [
        F.struct(
            F.lit(float(threshold)).alias("threshold"),
            F.count_if(F.col(score) >= threshold).alias("n"),
        ).alias(f"t{number}")
        for number, threshold in enumerate(thresholds)
    ]
    wide = df.groupBy(flag).agg(*packed)
    names = [f"t{number}" for number in range(len(thresholds))]
    return wide.select(flag, F.inline(F.array(*names))).filter("n > 0")


def value_counts(df: DataFrame, *columns: str, by_count: bool = False) -> DataFrame:
    """Frequency table, sorted by key or by falling count."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *columns) if by_count else counts.orderBy(*columns)


def count_of_counts(counts: DataFrame, count: str = "n") -> DataFrame:
    """How many keys have each count."""
    return counts.groupBy(count).agg(F.count(F.lit(1)).alias("n_keys"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Number of different values per column."""
    packed = [
        F.struct(F.lit(name).alias("column_name"), F.countDistinct(name).alias("n_distinct")).alias(name)
        for name in columns
    ]
    return df.agg(*packed).select(F.inline(F.array(*columns)))


def top_counts(counts: DataFrame, n: int, *keys: str, count: str = "n") -> DataFrame:
    """The `n` largest counts, ties in key order."""
    return counts.orderBy(F.desc(count), *keys).limit(n)
