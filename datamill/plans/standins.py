"""The given tables in the shape of each job's input, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import bucket, share
from datamill.session import use_all_cores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_bucket(key: str, salt: str) -> str:
    return f"('0x' || substr(md5(cast({key} as varchar) || '{salt}'), 1, 8))::ubigint::bigint"


def sql_topic_id(name: str) -> str:
    unsigned = f"md5_number_upper({name})::hugeint"
    return (
        f"cast(case when {unsigned} >= 9223372036854775808 then {unsigned} - 18446744073709551616"
        f" else {unsigned} end as bigint)"
    )


# --- pair scores: one lineitem is one compared pair -----------------------------------

PAIR_DIMS = ["s0", "s1", "s2", "s3"]


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id1"),
        F.col("l_linenumber").cast("bigint").alias("id2"),
        (F.col("l_quantity") / 50).alias("s0"),
        (F.col("l_extendedprice") / 100000).alias("s1"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)) * 10).alias("s2"),
        (F.nullif(F.col("l_tax"), F.lit(0.0)) * 10).alias("s3"),
        (F.col("l_linestatus") == "F").alias("matched"),
    )


PAIRS_SQL = """
    select l_orderkey as id1, cast(l_linenumber as bigint) as id2,
           l_quantity / 50 as s0, l_extendedprice / 100000 as s1,
           nullif(l_discount, 0) * 10 as s2, nullif(l_tax, 0) * 10 as s3,
           l_linestatus = 'F' as matched
    from lineitem
"""

# --- ratings: a customer's order lines rate the parts -----------------------------------

ROW_KEY = "concat_ws(':', l_orderkey, l_linenumber)"


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: its own key, the customer, the part and the quantity."""
    scan = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines = use_all_cores(scan).select(
        "l_orderkey",
        F.expr(ROW_KEY).alias("row_key"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("rating"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user")
    )
    return lines.join(orders, "l_orderkey").select("row_key", "user", "item", "rating")


def alias_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab lines `part<TAB>lowest part of the same name and brand`, with an empty first
    field where the part already is the lowest."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    lowest = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("good"))
    bad = F.when(F.col("p_partkey") == F.col("good"), F.lit("")).otherwise(
        F.col("p_partkey").cast("string")
    )
    return part.join(lowest, ["p_name", "p_brand"]).select(
        F.concat_ws("\t", bad, F.col("good").cast("string")).alias("value")
    )


def name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab lines `part<TAB>name`, every 50th with a bad id and every 70th without a tab."""
    key = F.col("p_partkey")
    shown = F.when(key % 50 == 0, F.lit("x")).otherwise(key.cast("string"))
    line = F.when(key % 70 == 0, shown).otherwise(F.concat(shown, F.lit("\t"), F.col("p_name")))
    return table(spark, sf_dir, "part").select(line.alias("value"))


ALIAS_SQL = """
    select p_partkey as bad_id, good_id
    from (select p_partkey, min(p_partkey) over (partition by p_name, p_brand) as good_id from part)
    where p_partkey <> good_id
"""

RATINGS_SQL = f"""
    select concat_ws(':', l_orderkey, l_linenumber) as row_key, o_custkey as "user",
           coalesce(a.good_id, l_partkey) as item, l_quantity as rating
    from lineitem join orders on l_orderkey = o_orderkey
    left join ({ALIAS_SQL}) a on l_partkey = a.bad_id
"""

TRAIN_BOUND = share(0.9)

SPLIT_RATINGS_SQL = f"""
    select r.*, case when {sql_bucket('row_key', 'split')} < {TRAIN_BOUND} then 0 else 1 end as split
    from ({RATINGS_SQL}) r
"""

# --- labelled records --------------------------------------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a 1-based class number made from the return flag."""
    number = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    scan = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", *NUMERIC, "l_linestatus", "l_returnflag"
    )
    return use_all_cores(scan).select(
        F.expr(ROW_KEY).alias("row_key"),
        *NUMERIC,
        "l_linestatus",
        "l_linenumber",
        number.cast("double").alias("class_number"),
    )


LABELLED_SQL = """
    select concat_ws(':', l_orderkey, l_linenumber) as row_key,
           l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_linenumber,
           cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as double) as label
    from lineitem
"""


def sql_split(key: str, weights: list[float], salt: str = "split") -> str:
    reached, cases = 0.0, []
    for number, weight in enumerate(weights[:-1]):
        reached += weight / sum(weights)
        cases.append(f"when {sql_bucket(key, salt)} < {share(reached)} then {number}")
    return f"cast(case {' '.join(cases)} else {len(weights) - 1} end as integer)"


# --- connection records -------------------------------------------------------------------

SYMBOLIC = ["l_returnflag", "l_linestatus", "o_orderpriority"]


def connection_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First numeric column, three symbolic columns, further numerics, a text label."""
    lines = use_all_cores(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        "l_extendedprice", "l_discount", "l_tax",
    ))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus"
    )
    return lines.join(orders, "l_orderkey")


# --- vectors ---------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return use_all_cores(rows).select("vec_id", F.col("embedding").cast("array<double>").alias("point"), "label")


# --- topics ----------------------------------------------------------------------------------


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per topic named in a record: the record is an order, the topic a part."""
    topic = F.concat(F.lit("part_"), F.col("l_partkey").cast("string"))
    rows = use_all_cores(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"))
    return rows.select(F.col("l_orderkey").alias("record"), topic.alias("topic"))


TOPICS_SQL = "select l_orderkey as record, 'part_' || l_partkey as topic from lineitem"


def in_bucket(key: Column, salt: str, parts: int) -> Column:
    return bucket(key, salt) % parts == 0
