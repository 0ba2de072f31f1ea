"""The six jobs over their own file formats, each giving its result tables by name.

    python -m datamill.plans.jobs linkage --input DIR --output DIR
"""

from __future__ import annotations

import argparse

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import topic_id
from datamill.operators import classify, cluster, network, profile, recommend, sampling, terms
from datamill.sources import markup, text_files
from datamill.session import build_session, cut, persisted

Results = dict[str, DataFrame]


def linkage(spark: SparkSession, path: str, scores: int = 9, chosen: tuple[int, ...] = (2, 5, 6, 7, 8)) -> Results:
    """Statistics of pair scores, contrast by match flag, counts above two thresholds."""
    pairs = text_files.read_pair_scores(spark, path, scores)
    dims = {f"s{i}": F.col(f"s{i}") for i in range(scores)}
    scored = pairs.select("matched", profile.total_score([dims[f"s{i}"] for i in chosen]).alias("score"))
    return {
        "match_counts": profile.value_counts(pairs, "matched", by_count=True),
        "stats": profile.missing_stats(pairs, dims),
        "stats_by_match": profile.missing_stats(pairs, dims, ["matched"]),
        "contrast": profile.flag_contrast(pairs, dims, "matched"),
        "thresholds": profile.threshold_contingency(scored, "score", "matched", [4.0, 2.0]),
    }


def recommender(
    spark: SparkSession, ratings_path: str, names_path: str, alias_path: str, user: int | None = None,
    grid=recommend.FULL_GRID, rank: int = 50, iterations: int = 10, reg: float = 1.0, alpha: float = 40.0,
) -> Results:
    """Popularity and model AUC, the setting grid, and items for one and for 100 users."""
    raw = text_files.read_ratings(spark, ratings_path)
    alias = text_files.parse_alias_lines(text_files.read_lines(spark, alias_path))
    names = text_files.parse_name_lines(text_files.read_lines(spark, names_path))
    ratings = cut(recommend.canonical_ratings(raw, alias))
    key = F.concat_ws(":", "user", "item", "rating")
    train, held_out = sampling.hash_split(ratings, key, [0.9, 0.1])
    items = ratings.select("item").distinct()
    model = recommend.train_factors(ratings, rank, iterations, reg, alpha)
    one = recommend.heaviest_users(ratings, 1) if user is None else spark.createDataFrame([(user,)], "user int")
    picks = recommend.recommend(model, one, 5)
    # The first model, of small rank and hardly regularised, is asked for the same user.
    first_picks = cut(recommend.recommend(recommend.train_factors(ratings, 10, 5, 0.01, 1.0), one, 5))
    some = ratings.select("user").distinct().orderBy("user").limit(100)
    return {
        "user_stats": profile.column_stats(raw, "user"),
        "item_stats": profile.column_stats(raw, "item"),
        "popularity_auc": recommend.mean_auc(
            held_out, items, lambda pairs: recommend.popularity_scores(pairs, train)
        ),
        "grid": recommend.factor_grid(train, held_out, items, grid),
        "first_picks": first_picks.join(names, "item", "left"),
        "history": recommend.names_of(names, recommend.user_history(ratings, one)),
        "picks": picks.join(names, "item", "left"),
        "pick_lines": recommend.recommendation_lines(recommend.recommend(model, some, 5)),
    }


def trees(
    spark: SparkSession, path: str, numeric: int = 10, blocks: tuple[int, ...] = (4, 40),
    grid=classify.FULL_GRID, category_grid=classify.FULL_CATEGORY_GRID, forest_trees: int = 20,
    record: str | None = None,
) -> Results:
    """Tree metrics, chance accuracy, both grids, the forest's test accuracy, and its answer
    for `record`, a comma line of the numbers and then the category of each block."""
    width = numeric + sum(blocks)
    names = [f"f{i}" for i in range(width)]
    raw = text_files.read_labelled_numbers(spark, path, width).withColumn("row_key", F.concat_ws(",", *names))
    plain = classify.labelled_features(raw, names, "class_number", "row_key")

    def first(train: DataFrame, validation: DataFrame, test: DataFrame) -> Results:
        guesses = classify.train_tree(train).transform(validation).select("label", "prediction")
        return {
            "confusion": cut(classify.confusion_matrix(guesses)),
            "metrics": cut(classify.class_metrics(guesses)),
            "chance_accuracy": cut(classify.chance_accuracy(train, validation)),
            "grid": classify.tree_grid(train, validation, grid),
            "best": classify.best_tree(train, train.unionByName(validation), test),
        }

    results = sampling.on_splits(plain, F.col("row_key"), first)
    values, starts = F.array(*names), [numeric + sum(blocks[:i]) for i in range(len(blocks))]
    index = {
        f"block{i}": classify.block_index(values, start, size)
        for i, (start, size) in enumerate(zip(starts, blocks))
    }
    texts = raw.withColumns(index).withColumns({name: F.col(name).cast("string") for name in index})
    labelled = texts.withColumn("label", F.col("class_number") - 1)
    stages = classify.categorical_features(list(index), names[:numeric]).fit(labelled)
    categorical = stages.transform(labelled).select("row_key", "features", "label")

    def second(train: DataFrame, validation: DataFrame, test: DataFrame) -> Results:
        forest = classify.train_forest(train, forest_trees)
        known = train.unionByName(validation)
        asked: Results = {}
        if record is not None:
            cells = record.split(",")
            values = [F.lit(float(c)).alias(name) for c, name in zip(cells, names[:numeric])]
            kinds = [F.lit(str(float(c))).alias(name) for c, name in zip(cells[numeric:], index)]
            row = stages.transform(spark.range(1).select(*values, *kinds))
            asked["record_class"] = forest.transform(row).select((F.col("prediction") + 1).alias("class_number"))
        return asked | {
            "category_grid": classify.tree_grid(train, validation, category_grid),
            "category_best": classify.best_tree(known, known, test, classify.TreeSetting("entropy", 30, 300)),
            "forest_confusion": cut(classify.confusion_matrix(forest.transform(test))),
        }

    return results | sampling.on_splits(categorical, F.col("row_key"), second)


def anomaly(
    spark: SparkSession, path: str, numeric_after: int = 37, ks=range(5, 41, 5), scaled_ks=range(60, 121, 10),
    entropy_ks=range(80, 161, 10), k: int = 150, place: int = 100, sample_path: str | None = None,
    fine_ks=range(30, 101, 10),
) -> Results:
    """Label counts, k scans on plain (with a small tolerance as well), scaled and one-hot
    features, and the outliers."""
    rows = text_files.read_connections(spark, path, numeric_after)
    first, rest = ["n0"], [f"n{i}" for i in range(1, numeric_after + 1)]
    symbols = ["symbol1", "symbol2", "symbol3"]
    plain = cluster.assemble(rows, first + rest).select("features", "label")
    stages: Transformer = cluster.one_hot_features(rows, first, symbols, rest)
    blocks = stages.transform(rows).select("features", "label")
    scale = cluster.fit_standardiser(blocks)
    scaled_blocks = scale(blocks)
    with persisted(plain) as (kept,):
        model = cluster.train_kmeans(kept)
        two = cut(cluster.cluster_label_counts(model.transform(kept)))
        if sample_path:
            lines = cluster.sample_lines(kept, cluster.train_kmeans(kept, 100, 1e-6))
            text_files.write_lines(lines, ["value"], sample_path)
    with persisted(scaled_blocks) as (kept,):
        many = cut(cluster.cluster_label_counts(cluster.train_kmeans(kept, k, 1e-6).transform(kept)))
    detect = cluster.fit_detector(rows, stages, scale, k, place)
    return {
        "label_counts": profile.value_counts(rows, "label", by_count=True),
        "two_clusters": two,
        "plain_scan": cluster.distance_scan(plain, ks),
        "plain_scan_fine": cluster.distance_scan(plain, fine_ks, 1e-6),
        "scaled_scan": cluster.distance_scan(cluster.standardise(plain), scaled_ks),
        "one_hot_scan": cluster.distance_scan(scaled_blocks, entropy_ks, 1e-6),
        "entropy_scan": cluster.entropy_scan(scaled_blocks, entropy_ks),
        "clusters": many,
        "outliers": detect(rows),
    }


def concepts(
    spark: SparkSession, path: str, stop_words_path: str | None = None, fraction: float = 0.1,
    num_terms: int = 50_000, k: int = 100, num_concepts: int = 10, frequencies_path: str | None = None,
) -> Results:
    """Top terms and documents of the leading concepts of a sample of pages."""
    pages = sampling.bernoulli_sample(markup.read_pages(spark, path), fraction, seed=11)
    articles = terms.keep_articles(pages, "title", "content", "is_article", "is_redirect")
    stops = text_files.read_stop_words(spark, stop_words_path) if stop_words_path else terms.STOP_WORDS
    kept = cut(terms.doc_terms(articles, "title", "content", stops))
    if frequencies_path:
        counts = terms.doc_frequency(terms.term_frequency(kept))
        text_files.write_doc_frequencies(terms.vocabulary(counts, num_terms), frequencies_path)
    found = terms.latent_concepts(kept, num_terms, k, num_concepts)
    return {
        "singular_values": found.singular_values,
        "top_terms": terms.top_terms(found, 10),
        "top_docs": terms.top_docs(found, 10),
    }


def topics(
    spark: SparkSession, path: str, limit: float = 19.5, fraction: float = 0.02, contains: str = "Campylobacter"
) -> Results:
    """Counts, components, degrees, chi-square, clustering and path lengths of topics, the
    members of the second largest component, and the counts of topics that hold a word."""
    records = cut(markup.read_citation_topics(spark, path))
    rows = network.topic_rows(records, "record", "topics")
    counts = network.topic_counts(rows)
    vertices = network.graph_vertices(rows)
    edges = cut(network.graph_edges(rows))
    components = cut(network.connected_components(vertices, edges))
    degree = network.degrees(edges)
    by_id = counts.select(topic_id(F.col("topic")).alias("id"), "n")
    weighted = cut(network.chi_square_edges(edges, by_id, records.count()))
    strong = cut(weighted.filter(F.col("chi2") > limit))
    strong_degree = network.degrees(strong)
    paths = cut(network.sample_path_lengths(strong, sampling.hash_sample(vertices, F.col("id"), fraction)))
    named = edges.join(vertices.toDF("src", "first"), "src").join(vertices.toDF("dst", "second"), "dst")
    return {
        "topic_counts": profile.top_counts(counts, 10, "topic"),
        "count_of_counts": profile.count_of_counts(counts).orderBy("n"),
        "top_pairs": profile.top_counts(named.select("first", "second", "cnt"), 10, "first", "second", count="cnt"),
        "components": network.component_sizes(components),
        "second_component": network.component_members(components, vertices, place=1),
        "containing": network.topic_counts(rows.filter(F.col("topic").contains(contains))),
        "degree_stats": profile.column_stats(degree, "degree"),
        "top_degrees": network.top_degree_names(degree, vertices, 10),
        "chi_square_stats": profile.column_stats(weighted, "chi2"),
        "strong_components": network.component_sizes(network.connected_components(vertices, strong)),
        "strong_degree_stats": profile.column_stats(strong_degree, "degree"),
        "strong_top_degrees": network.top_degree_names(strong_degree, vertices, 10),
        "clustering": network.average_clustering(vertices, strong),
        "path_stats": profile.column_stats(paths.filter("hops > 0"), "hops"),
        "path_histogram": profile.value_counts(paths, "hops"),
    }


JOBS = {
    "linkage": linkage, "recommender": recommender, "trees": trees,
    "anomaly": anomaly, "concepts": concepts, "topics": topics,
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", nargs="+", required=True, help="paths in the order of the job's arguments")
    parser.add_argument("--output", required=True, help="folder for one Parquet table per result")
    args = parser.parse_args()
    spark = build_session(args.job)
    for name, table in JOBS[args.job](spark, *args.input).items():
        table.write.mode("errorifexists").parquet(f"{args.output}/{name}")
    spark.stop()


if __name__ == "__main__":
    main()
