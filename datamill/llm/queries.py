"""Registered queries of the package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; `oracle` is DuckDB SQL for the same rows."""

    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP10_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), levels as (
  select (13 * 2 ** unnest(range(0, 12)))::bigint as size
), starts as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from words, levels where len(w) >= size
), windows as (
  select doc_id, size, i, md5(array_to_string(w[i:i + size - 1], ' ')) as t from starts
), spread as (
  select *, min(doc_id) over (partition by size, t) as least, max(doc_id) over (partition by size, t) as most from windows
), gone as (
  select doc_id, list(distinct p) as gone from (
    select doc_id, unnest(range(i, i + 13)) as p from spread where size = 13 and least < doc_id) group by doc_id
), longest as (
  select doc_id, max(size) as longest from spread where least < most group by doc_id
), kept as (
  select words.doc_id, len(w) as n_words, coalesce(len(gone), 0) as n_removed, longest,
    case when gone is null then w
      else [w[p] for p in range(1, len(w) + 1) if not list_contains(gone, p)] end as kept
  from words left join gone using (doc_id) left join longest using (doc_id)
)
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed,
  sha256(array_to_string(kept, ' ')) as kept_sha256, coalesce(longest, 0)::bigint as longest
from kept
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.substrings import repeated_passages

    rows = repeated_passages(table(spark, sf_dir, "documents"), keep_text=False)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256", "longest")


OP6_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) end as s from words
), members as (
  select doc_id, len(s) as n, unnest(s) as t from sets
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c, any_value(a.n) as na, any_value(b.n) as nb
  from members a join members b on a.t = b.t and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by 1, 2
), links as (
  select a, b from shared where 100 * c >= 90 * (na + nb - c)
), reach(a, b) as (
  select doc_id, doc_id from sets union select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, len(any_value(s.s))::bigint as n_shingles, min(r.b) as component_id
from sets s join reach r on s.doc_id = r.a group by s.doc_id
"""


@query("op6_ngram_jaccard_join", OP6_SQL)
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP2_SQL = r"""
with rows as (
  select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as digest from pages
), first as (
  select *, min(page_id) over (partition by digest) as least from rows
)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when n >= 100 and page_id > least then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id > least then least end as refers_to
from first
"""


@query("op2_warc", OP2_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages")).drop("archive")


OP4_SQL = r"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5(coalesce(doc_id::varchar, '')) as key from documents
), sizes as (
  select source, sum(size)::bigint as source_size,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from rows group by source
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(3.0 * source_size) over (
      order by 3.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by 3.0 * source_size / weight, source nulls last
      rows between current row and unbounded following))::double as level
  from sizes
), plan as (
  select source, source_size, case when shared is null or 3.0 * source_size <= weight * shared
    then (3.0 * source_size)::double else (weight * shared)::double end as target
  from levels, (select arg_min(level, 3.0 * source_size / weight) as shared from levels
    where 3.0 * source_size / weight > level)
), budgets as (
  select *, floor(target + 1e-6)::bigint as budget from plan
), ends as (
  select *, sum(size) over (partition by source order by key, doc_id, size rows unbounded preceding) as stop from rows
)
select doc_id, e.source, size, source_size, target, (case when source_size = 0 then 0 else
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - (stop - size))) end)::bigint as taken
from ends e join budgets b on e.source is not distinct from b.source
"""


@query("op4_mix_sources", OP4_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))


@query("op7_nearest_neighbours")
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from datamill.llm.neighbours import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SHARDS = {f"shard-{i:02d}": 1.0 + (i % 4 == 0) for i in range(32)}


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.sharding import place

    return place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
with docs as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i:i + 4], ' ') as t
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from docs where len(w) >= 5)
), again as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, t) as n from windows) where n > 1
), repeats as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from again) group by doc_id
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select doc_id, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), measured as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    coalesce(n_dup, 0)::bigint as n_dup_lines, coalesce(n_lines, 0)::bigint as n_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words
  from docs left join repeats r using (doc_id) left join lines using (doc_id)
), ledger as (
  select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
    (case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
    + case when 10 * n_symbols > n_words then 4 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 15 * n_words then 8 else 0 end
    + case when 100 * n_dup_lines > 30 * n_lines then 16 else 0 end)::bigint as failed
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed & 7 = 0 as kept, failed
from ledger
"""


@query("op3_rule_ledger", OP3_SQL)
def op3_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.rules import BASE, CURRENT, ledger, passes
    from datamill.llm.tables import written

    rows = written(ledger(table(spark, sf_dir, "documents")))
    counted = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(*counted, (~passes(BASE)).alias("base_failed"), passes(CURRENT).alias("kept"), "failed")


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.pii import digest, personal_data

    return digest(personal_data(table(spark, sf_dir, "documents")))


OP11_SQL = r"""
with lines as (
  select doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(w) as line, unnest(range(1, len(w) + 1)) as i
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as w from documents))
), common as (
  select key, max(doc_id) as last from lines where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), marked as (
  select doc_id, i, line, last is not null and doc_id <> last as gone from lines left join common using (key)
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


@query("op11_line_dedup", OP11_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from datamill.llm.lines import drop_common_lines

    rows = drop_common_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP12_SQL = r"""
with docs as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), spoken as (
  select doc_id, w, len(w)::bigint as n from docs where len(w) > 0
), total as (
  select count(*)::bigint as docs, sum(n)::bigint as terms from spoken
), tf as (
  select doc_id, n, t, count(*)::bigint as tf from (select doc_id, n, unnest(w) as t from spoken) group by all
), weights as (
  select t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as weight from tf, total group by t
), wanted as (
  select item_id, t, count(*)::bigint as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark) group by all
), scored as (
  select item_id, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
  from wanted join weights using (t) join tf using (t), total group by item_id, doc_id
)
select item_id, rank::integer as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= 20
"""


@query("op12_ranked_search", OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.treap import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datamill.llm.alignment import align_tokenizers

    return align_tokenizers(table(spark, sf_dir, "documents"))
