"""Large XML files as one record per element, and what the jobs read from a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "title string, ns int, redirect struct<_title: string>, revision struct<text: string>"


def read_elements(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """The text from each `start` mark to the next `end` mark, as `value`.

    The end mark is the record separator of the text reader, so one huge file is split over
    tasks and no record is cut.
    """
    pieces = spark.read.text(path, lineSep=end)
    at = F.locate(start, F.col("value"))
    whole = F.concat(F.expr("substring(value, _at)"), F.lit(end))
    return pieces.withColumn("_at", at).filter("_at > 0").select(whole.alias("value"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an encyclopaedia dump: title, content, is_article, is_redirect."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE_SCHEMA).load(path)
    return pages.select(
        "title",
        F.col("revision.text").alias("content"),
        (F.coalesce("ns", F.lit(0)) == 0).alias("is_article"),
        F.col("redirect").isNotNull().alias("is_redirect"),
    )


def marked_names(xml: Column, element: str = "DescriptorName", mark: str = "MajorTopicYN") -> Column:
    """Texts of all elements of that name, at any depth, whose mark attribute is Y."""
    return F.xpath(xml, F.lit(f'//{element}[@{mark}="Y"]/text()'))


def read_citation_topics(spark: SparkSession, path: str) -> DataFrame:
    """Major topics of each citation: (record, topics). A record is known by its place in
    the read; citations without topics are kept with an empty list."""
    citations = read_elements(spark, path, "<MedlineCitation ", "</MedlineCitation>")
    return citations.select(
        F.monotonically_increasing_id().alias("record"), marked_names(F.col("value")).alias("topics")
    )
