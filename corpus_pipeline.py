"""From raw documents to packed sequences: every stage works on all that the last one kept.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it leaves, in their own columns. The last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.llm.jaccard import near_duplicates
from datamill.llm.mixing import copies, mix_sources
from datamill.llm.packing import pack_documents
from datamill.llm.pii import personal_data, redacted
from datamill.llm.tables import written
from datamill.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of toxicity."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Five-word shingles, similarity 0.8. Rows are named by id and text, so those that share an
    id compete only if their texts are equal or near. Of rows equal in both one stays. A row
    without an id gives way to one with an id.
    """
    name = F.pmod(F.xxhash64("doc_id", F.length("text"), "text"), F.lit(1 << 62)).alias("__name")
    row = F.min(F.struct(*docs.columns)).alias("__row")
    once = written(docs.groupBy(name).agg(row).select("__name", "__row.*"))
    groups = near_duplicates(once, k=5, percent=80, id_column="__name")
    placed = groups.select(F.col("doc_id").alias("__name"), "component_id").join(once.select("__name", "doc_id"), "__name")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__name")).alias("first")
    kept = placed.groupBy("component_id").agg(first).select(F.col("first.__name").alias("__name"))
    return once.join(kept, "__name", "left_semi").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    found = personal_data(docs).filter(F.size("spans") > 0)
    found = found.groupBy(F.col("doc_id").alias("__id"), F.col("print").alias("__print")).agg(F.first("spans").alias("__spans"))
    mine = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__print"))
    joined = docs.join(found, mine, "left")
    text = F.when(F.col("__spans").isNotNull(), redacted(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    rows = joined.withColumn("text", text)
    n_chars = F.when(F.col("__spans").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", n_chars.cast("bigint")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of each source up to its target, repeated where it is above the source."""
    return copies(docs, mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of one sequence length."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", redact),
    ("mixing", mix),
    ("packing", pack),
]

# The trained stages have no SQL twin; tests run every stage on messy rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
