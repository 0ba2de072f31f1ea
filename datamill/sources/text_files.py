"""Delimited and line files of the jobs, and the parsers of their lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as `value`, of a file or of all files of a folder."""
    return spark.read.text(path)


def read_pair_scores(spark: SparkSession, path: str, scores: int = 9, missing: str = "?") -> DataFrame:
    """Comma files with a header each: two ids, scores with a missing mark, a match flag."""
    columns = ["id1 int", "id2 int", *[f"s{i} double" for i in range(scores)], "matched boolean"]
    return spark.read.csv(
        path, schema=", ".join(columns), header=True, enforceSchema=True, nullValue=missing, mode="FAILFAST"
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated `user item count` lines."""
    return spark.read.csv(path, sep=" ", schema="user int, item int, rating double", mode="FAILFAST")


def parse_alias_lines(lines: DataFrame) -> DataFrame:
    """Tab lines `bad<TAB>good`; lines with an empty first field are skipped.

    One row per bad id. When it is repeated, the largest good id is taken, since lines of a
    distributed read have no last one.
    """
    fields = F.split("value", "\t")
    # The cast carries its own guard: the optimizer may move a cast before the filter.
    named = fields[0] != ""
    rows = lines.filter(named).select(
        F.when(named, fields[0]).cast("bigint").alias("bad_id"), fields[1].cast("bigint").alias("good_id")
    )
    return rows.groupBy("bad_id").agg(F.max("good_id").alias("good_id"))


def parse_name_lines(lines: DataFrame) -> DataFrame:
    """Lines `id<TAB>name` split at the first tab; rows without a name part or with an id
    that is not a whole number are dropped, names are trimmed."""
    fields = F.split("value", "\t", 2)
    item = F.when(fields[0].rlike(WHOLE_NUMBER), F.expr("try_cast(split(value, '\t', 2)[0] as bigint)"))
    rows = lines.filter(F.col("value").contains("\t")).select(item.alias("item"), F.trim(fields[1]).alias("name"))
    return rows.filter(F.col("item").isNotNull())


def read_labelled_numbers(spark: SparkSession, path: str, features: int) -> DataFrame:
    """Comma file without header: `features` numbers, then a class number counted from 1."""
    columns = [f"f{i} double" for i in range(features)] + ["class_number double"]
    return spark.read.csv(path, schema=", ".join(columns), mode="FAILFAST")


def read_connections(spark: SparkSession, path: str, numeric_after: int) -> DataFrame:
    """Comma file without header: a number, three symbols, further numbers, a text label."""
    columns = [
        "n0 double", "symbol1 string", "symbol2 string", "symbol3 string",
        *[f"n{i} double" for i in range(1, numeric_after + 1)], "label string",
    ]
    return spark.read.csv(path, schema=", ".join(columns), mode="FAILFAST")


def read_stop_words(spark: SparkSession, path: str) -> list[str]:
    """A stop-word file, one or more words per line. It is a word list, not data."""
    words = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word"))
    return sorted(row.word for row in words.filter("word <> ''").distinct().collect())


def write_lines(df: DataFrame, columns: Sequence[str], path: str, sep: str = ",") -> None:
    """Text files with the columns joined by `sep`."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value")).write.text(path)


def exported(df: DataFrame, columns: Sequence[str], path: str, sep: str = ",") -> DataFrame:
    """The lines that `write_lines` has put into `path`, read back from there. The writer
    commits all files of a job or none, and a folder that is there already is an error."""
    write_lines(df, columns, path, sep)
    return read_lines(df.sparkSession, path)


def write_doc_frequencies(frequencies: DataFrame, path: str) -> None:
    """`term<TAB>df` lines by falling frequency."""
    frequencies.select("term", "df").orderBy(F.desc("df"), "term").write.csv(path, sep="\t", quote="")


def read_doc_frequencies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="term string, df bigint", quote="")
