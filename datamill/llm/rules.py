"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one number
whose bits name the failed rules; policies are masks over those bits, so a new version or an
ablation is bitwise arithmetic on the ledger and never reads a text again. All of it is
column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import WORD, let

SYMBOLS = r"[^#*$%&|<>]+"
SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5

def _rules() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "too_few_words": n < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "repeated_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


# Fixed bit positions: a rule keeps its bit for good, and new rules take the next one.
RULE_NAMES = ("too_few_words", "repeated_words", "symbols", "word_length", "repeated_lines")


@dataclass(frozen=True)
class Policy:
    """A named version of what is rejected: a document that fails any of the rules."""

    name: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULE_NAMES.index(rule) for rule in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_words"))
POLICIES = (
    BASE,
    Policy("v1", (*BASE.rules, "symbols")),
    Policy("v2", RULE_NAMES),
)
# Repeated lines alone also hit good prose, so the strictest version is not the current one.
CURRENT = POLICIES[1]


def _repeated(words: Column, hashes: Column) -> Column:
    """Words inside windows that occur twice or more. Windows are compared as they are; the
    hashes only bring equal ones together faster."""
    window = lambda i: F.array_join(F.slice(words, i + 1, WINDOW), " ")
    sorted_ = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), window(i).alias("w"), i.alias("i")))
    )

    def starts(s: Column) -> Column:
        same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))
        # The array's own element and its neighbours; get() is null past either end.
        hit = F.transform(
            s, lambda x, j: F.when(same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)), x["i"])
        )
        return F.sort_array(F.filter(hit, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        # A window adds what lies before the next one starts.
        gaps = F.transform(at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    return let(sorted_, lambda s: let(starts(s), covered))


def _measured(words: Column) -> Column:
    n = F.size(words)
    hashed = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])
    )
    # Without two equal hashes no window repeats: nearly every text is done here.
    repeated = let(
        hashed,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(_repeated(words, h)),
    )
    return F.struct(
        n.cast("bigint").alias("n_words"),
        F.when(n >= WINDOW, repeated).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def ledger(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, and `failed`, the bits of its rules.

    A null text is empty: all measurements are 0 and it fails `too_few_words`. Texts of any
    length are measured whole. Rows that repeat, and rows without an id, have a row each. An
    empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    measured = documents.select("doc_id", text.alias("text")).select(
        "doc_id",
        let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), _measured).alias("w"),
        F.length(F.regexp_replace("text", SPACES, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        let(
            F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD)),
            lambda own: F.struct(
                F.size(own).cast("bigint").alias("n_lines"),
                (F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("n_dup_lines"),
            ),
        ).alias("l"),
    )
    rows = measured.select(
        "doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "l.n_lines", "w.n_repeat_words"
    )
    rules = _rules()
    bits = [F.when(rules[rule], F.lit(1 << bit)).otherwise(F.lit(0)) for bit, rule in enumerate(RULE_NAMES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed", failed.cast("bigint"))


def passes(policy: Policy) -> Column:
    """Does a row of the ledger pass the policy?"""
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, rejected, failing (by this rule), and sole, those that
    would be kept if only this rule were dropped.

    The ledger shrinks to a count per bit pattern, at most 2^rules of them, and everything
    else is arithmetic on the patterns.
    """
    cases = [
        F.struct(F.lit(p.name).alias("policy"), F.lit(r).alias("rule"), F.lit(p.mask).alias("mask"), F.lit(1 << RULE_NAMES.index(r)).alias("bit"))
        for p in policies
        for r in p.rules
    ]
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    spread = patterns.withColumn("case", F.explode(F.array(*cases))).select("failed", "n", "case.*")
    hit = F.col("failed").bitwiseAND(F.col("mask").cast("bigint"))
    count = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    return spread.groupBy("policy", "rule").agg(
        F.sum("n").alias("documents"),
        count(hit != 0).alias("rejected"),
        count(F.col("failed").bitwiseAND(F.col("bit").cast("bigint")) != 0).alias("failing"),
        count(hit == F.col("bit")).alias("sole"),
    )
