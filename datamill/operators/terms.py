"""Term frequencies, weights and latent concepts of a document collection."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from datamill.functions.text import STOP_WORDS, kept_terms
from datamill.operators.lowrank import best_rows, decompose, place_rows, whole_rows
from datamill.operators.ranking import top_per_group
from datamill.operators.skew import lookup
from datamill.session import cut, persisted

# Vocabularies of up to this many terms are sent to every task.
BROADCAST_TERMS = 100_000


def keep_articles(
    pages: DataFrame, title: str, content: str, is_article: str | None = None, is_redirect: str | None = None
) -> DataFrame:
    """Pages with a title and content that are articles, no redirects, no disambiguation."""
    kept = (
        (F.coalesce(F.col(content), F.lit("")) != "")
        & F.col(title).isNotNull()
        & (F.col(title) != "")
        & ~F.col(title).contains("(disambiguation)")
    )
    if is_article:
        kept &= F.col(is_article)
    if is_redirect:
        kept &= ~F.col(is_redirect)
    return pages.filter(kept)


def doc_terms(
    docs: DataFrame, doc: str, text: str, stop_words: Iterable[str] = STOP_WORDS, min_terms: int = 2
) -> DataFrame:
    """Kept terms of each document in order; documents with one term or none are dropped.

    The one-element `explode` keeps the size filter above the token expression; without it
    the optimizer pushes the filter down and every text is tokenised twice.
    """
    terms = F.explode(F.array(kept_terms(F.col(text), stop_words)))
    return docs.select(F.col(doc).alias("doc"), terms.alias("terms")).filter(F.size("terms") >= min_terms)


def term_frequency(terms: DataFrame) -> DataFrame:
    """Long table (doc, term, tf, doc_total); doc_total counts all kept terms of the doc."""
    rows = terms.select("doc", F.size("terms").cast("bigint").alias("doc_total"), F.explode("terms").alias("term"))
    return rows.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.max("doc_total").alias("doc_total"))


def doc_frequency(frequencies: DataFrame) -> DataFrame:
    """Number of documents per term, given one row per document and term."""
    return frequencies.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(doc_frequencies: DataFrame, num_terms: int) -> DataFrame:
    """The `num_terms` terms found in most documents, ties in term order.

    The frequency of the last one is found from the number of terms per frequency, so only
    terms that tie with it are ordered. The frequencies are written out, as both that and the
    result read them.
    """
    doc_frequencies = cut(doc_frequencies)
    sizes = doc_frequencies.groupBy("df").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < num_terms)
    last = sizes.orderBy("df").first()
    if last is None:
        return doc_frequencies
    more = doc_frequencies.filter(F.col("df") > last.df)
    ties = doc_frequencies.filter(F.col("df") == last.df)
    if last.above + last.n > num_terms:
        ties = ties.orderBy("term").limit(num_terms - last.above)
    return more.unionByName(ties)


def term_ids(vocab: DataFrame) -> DataFrame:
    """Ids 0, 1, … by falling document frequency. One task numbers the vocabulary, whose
    size is the `num_terms` parameter and does not grow with the data."""
    order = Window.orderBy(F.desc("df"), "term")
    return vocab.select("term", "df", (F.row_number().over(order) - 1).cast("bigint").alias("term_id"))


def inverse_doc_frequency(vocab: DataFrame, num_docs: int) -> DataFrame:
    """idf = ln(documents / documents with the term), without smoothing."""
    return vocab.withColumn("idf", F.log(F.lit(float(num_docs)) / F.col("df")))


def tf_idf(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """Weight of each vocabulary term of each document: idf · tf / all kept terms of it.

    The vocabulary, whose size is a parameter, is sent to every task, so that the frequencies
    stay where they are; a very large one is joined by a shuffle.
    """
    idf = cut(idf)
    if idf.count() <= BROADCAST_TERMS:
        joined = frequencies.join(F.broadcast(idf), "term")
    else:
        joined = lookup(frequencies, idf, "term", how="inner", spread=["doc"])
    return joined.withColumn("weight", F.col("idf") * F.col("tf") / F.col("doc_total"))


class Concepts(NamedTuple):
    """Singular values, term weights (term, concept, weight) and document weights
    (doc, concept, weight), each where asked for; concepts count from 0 by falling
    singular value. `placed` has the weights of a document in one row (row, weights)."""

    singular_values: DataFrame
    terms: DataFrame | None
    docs: DataFrame | None
    placed: DataFrame | None = None


def weight_entries(terms: DataFrame, num_terms: int) -> tuple[DataFrame, DataFrame, int]:
    """The document-term weights as entries (row, column, value), the vocabulary
    (term, df, term_id, idf), whose ids are the columns, and the number of entries."""
    frequencies = cut(term_frequency(terms))
    sizes = frequencies.agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("doc").alias("docs")).first()
    vocab = term_ids(vocabulary(doc_frequency(frequencies), num_terms))
    idf = cut(inverse_doc_frequency(vocab, sizes.docs))
    weights = tf_idf(frequencies, idf)
    entries = weights.select(F.col("doc").alias("row"), F.col("term_id").alias("column"), F.col("weight").alias("value"))
    return entries, idf, sizes.entries


def latent_concepts(
    terms: DataFrame, num_terms: int = 50_000, k: int = 100, num_concepts: int | None = None,
    place_terms: bool = True, place_docs: bool = True,
) -> Concepts:
    """Truncated singular value decomposition of the document-term weights.

    Only the k term vectors and the block they come from reach the driver; their size is set
    by the parameters. Document weights U = A·V/s are made where a document's weights are.
    """
    spark = terms.sparkSession
    num_concepts = min(num_concepts or k, k)
    entries, idf, total = weight_entries(terms, num_terms)
    with persisted(whole_rows(entries, total)) as (rows,):
        values, loadings = decompose(rows, idf.count(), k)
        num_concepts = min(num_concepts, len(values))
        placed = cut(place_rows(rows, loadings[:, :num_concepts] / values[:num_concepts])) if place_docs else None

    schema = "concept bigint, singular_value double"
    singular = spark.createDataFrame(list(enumerate(values.tolist())), schema)
    opened = F.posexplode("weights").alias("concept", "weight")
    concept = F.col("concept").cast("bigint").alias("concept")
    term_weights = None
    if place_terms:
        # One row per term, so the session needs no Arrow to take it in.
        by_id = spark.createDataFrame(
            list(enumerate(loadings[:, :num_concepts].tolist())), "term_id bigint, weights array<double>"
        )
        named = idf.select("term", "term_id").join(by_id, "term_id")
        term_weights = named.select("term", opened).select("term", concept, "weight")
    docs = None
    if placed is not None:
        docs = placed.select(F.col("row").alias("doc"), opened).select("doc", concept, "weight")
    return Concepts(singular, term_weights, docs, placed)


def top_terms(concepts: Concepts, n: int) -> DataFrame:
    """The `n` terms of largest weight in each concept."""
    return top_per_group(concepts.terms, ["concept"], [F.desc("weight"), F.col("term")], n, "place")


def top_docs(concepts: Concepts, n: int) -> DataFrame:
    """The `n` documents of largest weight in each concept."""
    docs = concepts.docs
    if concepts.placed is not None:
        # Only those that are among the best of a task are ordered.
        found = best_rows(concepts.placed, n)
        docs = found.select(F.col("row").alias("doc"), F.col("place").alias("concept"), "weight")
    return top_per_group(docs, ["concept"], [F.desc("weight"), F.col("doc")], n, "place")
