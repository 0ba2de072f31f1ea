"""Record linkage profiling: statistics of pair scores and of matched against unmatched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.operators import profile
from datamill.plans.registry import query
from datamill.plans.standins import PAIR_DIMS, PAIRS_SQL, pair_scores, table


def dims() -> dict:
    return {name: F.col(name) for name in PAIR_DIMS}


def sql_stats(select: str, where: str = "") -> str:
    """SQL statistics per dimension, one branch per dimension."""
    branch = """
        select '{d}' as dim, count({d}) as n, round(avg({d}), 6) as mean,
               round(stddev_pop({d}), 6) as stdev, min({d}) as "min", max({d}) as "max",
               count(*) - count({d}) as missing
        from p
    """
    branches = " union all ".join(branch.format(d=d) for d in PAIR_DIMS)
    return f"with p as ({PAIRS_SQL}) select {select} from ({branches}) {where}"


def rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"mean": F.round("mean", 6), "stdev": F.round("stdev", 6)})


@query(
    "linkage_parse",
    f"select id1, id2, round(s0, 9) as s0, round(s1, 9) as s1, round(s2, 9) as s2, round(s3, 9) as s3, matched from ({PAIRS_SQL})",
)
def linkage_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write each pair as a comma line with `?` for missing scores and parse it back."""
    pairs = pair_scores(spark, sf_dir)
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("?")) for name in pairs.columns]
    lines = pairs.select(F.concat_ws(",", *cells).alias("value"))
    parsed = profile.parse_pair_scores(lines, len(PAIR_DIMS))
    return parsed.select("id1", "id2", *[F.round(d, 9).alias(d) for d in PAIR_DIMS], "matched")


@query("missing_stats", sql_stats("*"))
def missing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.missing_stats(pair_scores(spark, sf_dir), dims()))


@query("dim_stats", sql_stats('dim, n, mean, stdev, "min", "max"'))
def dim_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.dim_stats(pair_scores(spark, sf_dir), dims()))


CONTRAST_SQL = f"with p as ({PAIRS_SQL}) " + " union all ".join(
    f"""select '{d}' as dim, count(*) - count({d}) as missing,
        round(avg({d}) filter (where matched) - avg({d}) filter (where not matched), 6) as mean_gap
        from p"""
    for d in PAIR_DIMS
)


@query("matched_contrast", CONTRAST_SQL)
def matched_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    contrast = profile.flag_contrast(pair_scores(spark, sf_dir), dims(), "matched")
    return contrast.withColumn("mean_gap", F.round("mean_gap", 6))


SCORE_SQL = f"""
    select id1, id2, matched,
           coalesce(s0, 0) + coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) as score
    from ({PAIRS_SQL})
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = profile.total_score(list(dims().values()))
    return pair_scores(spark, sf_dir).select("id1", "id2", "matched", score.alias("score"))


@query("linkage_score", f"select id1, id2, matched, round(score, 9) as score from ({SCORE_SQL})")
def linkage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).withColumn("score", F.round("score", 9))


@query(
    "score_threshold_contingency",
    f"""
    select matched, threshold, count(*) as n
    from ({SCORE_SQL}) s
    join (values (cast(2.0 as double)), (cast(1.0 as double))) t(threshold) on s.score >= t.threshold
    group by matched, threshold
    """,
)
def score_threshold_contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.threshold_contingency(scored(spark, sf_dir), "score", "matched", [2.0, 1.0])


@query("value_counts", "select l_returnflag, count(*) as n from lineitem group by l_returnflag")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag", by_count=True)


@query(
    "column_stats",
    """
    select 'l_quantity' as dim, count(l_quantity) as n, round(avg(l_quantity), 6) as mean,
           round(stddev_pop(l_quantity), 6) as stdev, min(l_quantity) as "min", max(l_quantity) as "max"
    from lineitem
    """,
)
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.column_stats(table(spark, sf_dir, "lineitem"), "l_quantity"))


KEY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey"]


@query(
    "distinct_counts",
    " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_distinct from lineitem" for c in KEY_COLUMNS
    ),
)
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(table(spark, sf_dir, "lineitem"), *KEY_COLUMNS)
