"""Latent semantic analysis: pages, terms, weights and concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions import text as words
from datamill.operators import terms as ops
from datamill.plans.registry import query
from datamill.plans.standins import table
from datamill.session import cut, use_all_cores

NUM_TERMS, NUM_CONCEPTS = 50_000, 100


@query(
    "tag_fragments",
    """
    select page_id, cast(position - 1 as integer) as position, fragments[position] as fragment
    from (select page_id, fragments, unnest(range(1, len(fragments) + 1)) as position
          from (select page_id, regexp_extract_all(html, '(?s)<p(?: [^>]*)?>.*?</p>') as fragments from pages))
    """,
)
def tag_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", F.posexplode(words.tag_fragments(F.col("html"), "p")).alias("position", "fragment"))


@query(
    "page_articles",
    r"""
    select page_id, title, content
    from (select page_id, url, regexp_extract(html, '(?s)<title(?: [^>]*)?>(.*?)</title>', 1) as title,
                 trim(regexp_replace(regexp_replace(
                     regexp_extract(html, '(?s)<article(?: [^>]*)?>(.*?)</article>', 1),
                     '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) as content
          from pages)
    where title <> '' and content <> '' and not contains(title, '(disambiguation)')
      and not contains(url, 'utm_')
    """,
)
def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        words.between_tags(html, "title").alias("title"),
        words.strip_tags(words.between_tags(html, "article")).alias("content"),
        F.col("url").contains("utm_").alias("is_redirect"),
    )
    return ops.keep_articles(pages, "title", "content", is_redirect="is_redirect").drop("is_redirect")


@query(
    "html_attribute_extract",
    """select page_id, regexp_extract(html, '<html(?: [^>]*)? lang="([^"]*)"', 1) as lang from pages""",
)
def html_attribute_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", words.tag_attribute(F.col("html"), "html", "lang").alias("lang"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ops.doc_terms(use_all_cores(docs), "doc_id", "text")


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.term_frequency(kept(spark, sf_dir))


STOP_SQL = ", ".join("'" + word.replace("'", "''") + "'" for word in words.STOP_WORDS)

TERMS_SQL = rf"""
    terms as materialized (
        select doc, terms, len(terms) as doc_total
        from (select doc_id as doc,
                     list_filter(regexp_extract_all(replace(lower(text), '’', chr(39)),
                                                    '[\p{{L}}\p{{N}}]+(?:''[\p{{L}}\p{{N}}]+)*'),
                                 lambda t: length(t) > 2 and regexp_full_match(t, '\p{{L}}+')
                                           and t not in ({STOP_SQL})) as terms
              from documents)
        where len(terms) > 1),
    tf as materialized (
        select doc, doc_total, term, count(*) as tf
        from (select doc, doc_total, unnest(terms) as term from terms) group by all),
    dfs as (select term, count(*) as df from tf group by term),
    vocab as (select term, df from dfs order by df desc, term limit {NUM_TERMS}),
    idfs as (select term, df, ln((select count(*) from terms)::double / df) as idf from vocab)
"""


@query(
    "term_filter",
    f"""with {TERMS_SQL}
    select doc, position, term from (
        select doc, unnest(range(len(terms)))::integer as position, unnest(terms) as term from terms)""",
)
def term_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir).select("doc", F.posexplode("terms").alias("position", "term"))


@query(
    "doc_terms",
    f"with {TERMS_SQL} select doc, doc_total as n_terms, array_to_string(terms, ' ') as terms from terms",
)
def doc_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir).select(
        "doc", F.size("terms").cast("bigint").alias("n_terms"), F.array_join("terms", " ").alias("terms")
    )


@query("term_frequency", f"with {TERMS_SQL} select doc, term, tf from tf")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequencies(spark, sf_dir).select("doc", "term", "tf")


@query("doc_frequency", f"with {TERMS_SQL} select term, df from dfs")
def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.doc_frequency(frequencies(spark, sf_dir))


@query("vocabulary", f"with {TERMS_SQL} select term, df from vocab")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.vocabulary(doc_frequency(spark, sf_dir), NUM_TERMS)


@query(
    "term_ids",
    f"""with {TERMS_SQL}
    select term, df, row_number() over (order by df desc, term) - 1 as term_id from vocab""",
)
def term_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.term_ids(vocabulary(spark, sf_dir))


def idf_table(tf: DataFrame) -> DataFrame:
    num_docs = tf.select("doc").distinct().count()
    return ops.inverse_doc_frequency(ops.vocabulary(ops.doc_frequency(tf), NUM_TERMS), num_docs)


@query("idf", f"with {TERMS_SQL} select term, df, round(idf, 6) as idf from idfs")
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idf_table(cut(frequencies(spark, sf_dir))).select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "tfidf",
    f"""with {TERMS_SQL}
    select doc, term, round(idf * tf / doc_total, 6) as weight from tf join idfs using (term)""",
)
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tf = cut(frequencies(spark, sf_dir))
    weights = ops.tf_idf(tf, idf_table(tf))
    return weights.select("doc", "term", F.round("weight", 6).alias("weight"))


def concepts(spark: SparkSession, sf_dir: str, **wanted: bool) -> ops.Concepts:
    return ops.latent_concepts(kept(spark, sf_dir), NUM_TERMS, NUM_CONCEPTS, **wanted)


@query("lsa_singular_values")
def lsa_singular_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts(spark, sf_dir, place_terms=False, place_docs=False).singular_values


@query("lsa_top_terms")
def lsa_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_terms(concepts(spark, sf_dir, place_docs=False), 10)


@query("lsa_top_docs")
def lsa_top_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_docs(concepts(spark, sf_dir, place_terms=False), 10)
