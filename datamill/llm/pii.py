"""Personal data: spans by strict formats, and further spans by boosted trees.

Base spans are the matches of one strict pattern per kind that pass its check. Beside them,
loose patterns propose candidates that may overlap. Their format and context become
features; the checks (checksum, ranges, number of digits) are the labels and no features, so
the trees learn what valid data look like, and give a probability to candidates that a
strict pattern misses, such as addresses written with [at] or numbers with odd separators.
Per kind, the least probability at which the candidates set aside, all whose value the trees
have not seen, are right often enough is the threshold; where a kind has few, those of all
kinds and the trees' own word count beside them. Everything is column expressions and Spark's own tree learner.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<start:int,end:int,kind:int>>"

# The strict patterns, written so that the matcher neither recurses nor scans a long run
# again and again: a match starts where a run starts or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Only runs of 14 to 19 digits; the strict pattern's other matches fail the check.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++ ?(?:@|[\[({{] ?(?:at|AT) ?[\])}}]) ?[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\.|,|\[\.\]|\(\.\))[0-9]{1,4}){3}+",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]?[0-9]){9,15}+",
    "phone": r"(?:\+|\(|(?<![0-9]))[0-9]{1,4}(?:[ ()./-]{1,2}[0-9]{2,5}){2,5}+",
}
# What every match of a kind holds, strict or loose, and is quick to look for; texts without
# it are not scanned. A card has 14 digits or more, its loose form 13.
NEEDS = {
    "email": r"@|[\[({] ?(?:at|AT)\b",
    "ip": r"[0-9](?:[.,]|\[\.\]|\(\.\))[0-9]",
    "card": r"[0-9](?:[ ._/-]?[0-9]){12}+",
    "phone": r"\+[0-9]|[0-9][ ()./-]{1,2}[0-9]{2}",
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|reach)",
    "ip": r"(?i)(?:\bip\b|address|host|server|login|from)",
    "card": r"(?i)(?:card|visa|master|amex|credit|debit|pay)",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|dial|cell)",
}
CONTEXT = 24
MODEL_ROWS = 20_000
TREES, DEPTH = 12, 4
RIGHT = 0.97
STEPS, PRIOR = 20, 10
FEATURES = (
    [f"is_{k}" for k in KINDS]
    + ["length", "digits", "letters", "separators", "kinds_of_separator", "longest_run", "plus", "bracket", "at_sign"]
    + ["cue", "joined_left", "joined_right", "digit_near", "hex_near", "first_digit"]
)


def _number(column: Column) -> Column:
    return column.cast("int")


def matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: array of (start, end, value), in code points.

    The pieces between the matches give the places: split and extract find the same ones.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def add(done: Column, pair: Column) -> Column:
        begin = done["at"] + pair["g"]
        end = begin + F.length(pair["m"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, start, add, lambda done: done["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Does the checksum over the digits of a value come out?"""
    digits = F.split(F.reverse(_digits(value)), "")
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check of a kind, on a value of its strict pattern or the loose form made plain."""
    n = F.length(_digits(value))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    if kind == "email":
        return value.rlike(rf"^{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    if kind == "ip":
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & luhn(value)
    return n.between(10, 15)


def _plain(kind: str, value: Column) -> Column:
    """A loosely written value in the strict form."""
    if kind == "email":
        value = F.regexp_replace(value, r" ?[\[({] ?(?:at|AT) ?[\])}] ?", "@")
        return F.regexp_replace(value, r" ?[\[({] ?(?:dot|DOT) ?[\])}] ?", ".")
    if kind == "ip":
        return F.regexp_replace(value, r"\[\.\]|\(\.\)|,", ".")
    return value


def _scan(text: Column, kind: str, pattern: str) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(NEEDS[kind]), matches(text, pattern)).otherwise(none)


def base_spans(text: Column, kind: str) -> Column:
    """Places of the strict matches that pass their check: array of (start, end, kind)."""
    passed = F.filter(_scan(text, kind, BASE[kind]), lambda m: valid(kind, m["value"]))
    number = F.lit(KINDS.index(kind))
    return F.transform(passed, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), number.alias("kind")))


def candidates(text: Column, kind: str) -> Column:
    """Loose matches with what stands around them."""
    number = F.lit(KINDS.index(kind))
    return F.transform(
        _scan(text, kind, LOOSE[kind]),
        lambda m: F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            number.alias("kind"),
            m["value"].alias("value"),
            F.substr(text, F.greatest(F.lit(1), m["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), m["start"])).alias("left"),
            F.substr(text, m["end"] + 1, F.lit(8)).alias("right"),
        ),
    )


def featured(rows: DataFrame) -> DataFrame:
    """Feature columns of candidates, and `label`, whether the kind's check passes."""
    value, kind = F.col("value"), F.col("kind")
    bare = F.regexp_replace(value, "[0-9A-Za-z]", "")
    by_kind = lambda make: F.coalesce(*[F.when(kind == i, make(k)) for i, k in enumerate(KINDS)])
    columns = {f"is_{k}": kind == i for i, k in enumerate(KINDS)}
    columns |= {
        "length": F.length(value),
        "digits": F.length(_digits(value)),
        "letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "separators": F.length(bare),
        "kinds_of_separator": F.size(F.array_distinct(F.split(bare, ""))),
        "longest_run": F.array_max(F.transform(F.split(value, "[^0-9]+"), lambda run: F.length(run))),
        "plus": value.startswith("+"),
        "bracket": value.rlike(r"[\[({]"),
        "at_sign": value.contains("@"),
        "cue": by_kind(lambda k: F.col("left").rlike(CUES[k])),
        "joined_left": F.col("left").rlike("[0-9A-Za-z.]$"),
        "joined_right": F.col("right").rlike("^[0-9A-Za-z]"),
        "digit_near": F.col("left").rlike(r"[0-9][^0-9A-Za-z]*$"),
        "hex_near": F.col("left").rlike("[0-9a-f]{3}$"),
        "first_digit": F.coalesce(F.substring(_digits(value), 1, 1).try_cast("int"), F.lit(-1)),
    }
    label = by_kind(lambda k: valid(k, _plain(k, value)))
    return rows.select(
        "*", *[F.coalesce(_number(columns[c]), F.lit(0)).cast("double").alias(c) for c in FEATURES],
        F.coalesce(_number(label), F.lit(0)).cast("double").alias("label"),
    )


def _sampled(found: DataFrame) -> DataFrame:
    """Candidates with `apart`, whether their value is kept from the trees, and `fit`, whether
    they train on it.

    A value is apart or not with all its rows. Three quarters of a kind's values may train, or
    fewer where the kind has many rows; of their rows about MODEL_ROWS / kinds per kind do.
    """
    per_kind, whole = MODEL_ROWS // len(KINDS), 1 << 20
    by_kind = lambda shares: F.coalesce(*[F.when(F.col("kind") == k, F.lit(int(whole * s))) for k, s in shares.items()], F.lit(0))
    sizes = {r.kind: r["count"] for r in found.groupBy("kind").count().collect()}
    values = by_kind({k: min(0.75, per_kind / n) for k, n in sizes.items()})
    found = found.withColumn("apart", F.pmod(F.xxhash64("value", "kind"), F.lit(whole)) >= values)
    sizes = {r.kind: r["count"] for r in found.filter("not apart").groupBy("kind").count().collect()}
    rows = by_kind({k: min(1.0, per_kind / n) for k, n in sizes.items()})
    # A value that stands in many places is thinned by place.
    place = F.pmod(F.xxhash64("doc_id", "print", "start", "end", "kind"), F.lit(whole))
    return found.withColumn("fit", ~F.col("apart") & (place < rows))


def thresholds(counts: dict[tuple[int, int], tuple[float, int]]) -> dict[int, float]:
    """Least probability per kind at which enough candidates are right, from (right, all) by
    kind and step of probability.

    To a kind's own counts come PRIOR candidates that are right as often as those of all kinds
    from the same step on; to these, PRIOR as often as the trees say, the middle of the step.
    So a kind with many candidates goes by its own, and one without any has a threshold too.
    """
    least: dict[int, float] = {}
    for kind in range(len(KINDS)):
        good = n = all_good = all_n = 0.0
        for step in range(STEPS, STEPS // 2 - 1, -1):
            for k in range(len(KINDS)):
                more = counts.get((k, step), (0.0, 0))
                all_good, all_n = all_good + more[0], all_n + more[1]
                if k == kind:
                    good, n = good + more[0], n + more[1]
            said = min(1.0, (step + 0.5) / STEPS)
            usual = (all_good + PRIOR * said) / (all_n + PRIOR)
            if good + PRIOR * usual >= RIGHT * (n + PRIOR):
                least[kind] = step / STEPS
        least.setdefault(kind, 1.0)
    return least


def _choose(found: DataFrame) -> DataFrame | None:
    """Candidates the trees choose; None where there is nothing to learn from."""
    sampled = _sampled(found)
    fit = written(featured(sampled.filter("fit")))
    if fit.select("label").distinct().count() < 2:
        return None
    gather = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11, featuresCol="features", labelCol="label")
    model = learner.fit(gather.transform(fit))
    scored = model.transform(gather.transform(featured(sampled))).withColumn("p", F.round(vector_to_array("probability")[1], 6))
    scored = written(scored.select("doc_id", "print", "start", "end", "kind", "p", "label", "apart"))
    # Shares of right candidates by kind and step, over all whose value the trees never saw.
    steps = scored.filter("apart").groupBy("kind", F.floor(F.col("p") * STEPS).alias("step"))
    rows = steps.agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    least = thresholds({(r.kind, r.step): (r.good, r.n) for r in rows})
    enough = F.coalesce(*[F.when(F.col("kind") == k, F.col("p") >= p) for k, p in least.items()])
    return scored.filter(enough).select("doc_id", "print", "start", "end", "kind", "p")


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _clear(proposed: Column, base: Column) -> Column:
    """Proposed spans that touch no base span, likeliest first, each kept if it touches none
    kept before."""
    free = F.filter(proposed, lambda s: ~F.exists(base, lambda b: _overlap(s, b)))
    ranked = F.sort_array(
        F.transform(free, lambda s: F.struct((-s["p"]).alias("low"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    return F.aggregate(
        ranked,
        F.array().cast(SPANS),
        lambda kept, s: F.when(F.exists(kept, lambda k: _overlap(k, s)), kept).otherwise(F.concat(kept, F.array(plain(s)))),
    )


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"].alias("k"), s["end"])))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, print, base and spans, arrays of (start, end, kind).

    Places are code points, end exclusive; `kind` is a place in KINDS. `base` has all strict
    spans, and `spans` those with what the trees add clear of them. `print` is a hash of the
    text; with doc_id it names a row.

    A null text is empty and has no spans. Texts of any length are read whole. Rows that
    repeat, and rows without an id, have a row each. Without candidates of both labels to
    train on nothing is added. An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    found = written(
        rows.select(
            "doc_id",
            F.xxhash64("text").alias("print"),
            F.concat(*[base_spans(F.col("text"), k) for k in KINDS]).alias("base"),
            F.concat(*[candidates(F.col("text"), k) for k in KINDS]).alias("loose"),
        )
    )
    opened = found.filter(F.size("loose") > 0).select("doc_id", "print", F.explode("loose").alias("c"))
    opened = opened.select("doc_id", "print", "c.*").distinct()
    chosen = _choose(opened)
    rows = found.select("doc_id", "print", "base")
    if chosen is None:
        return rows.withColumn("spans", F.col("base"))
    added = chosen.groupBy("doc_id", "print").agg(
        F.collect_list(F.struct("start", "end", "kind", "p")).alias("added")
    )
    added = added.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "added")
    joined = rows.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")), "left")
    none = F.array().cast("array<struct<start:int,end:int,kind:int,p:double>>")
    extra = _clear(F.coalesce("added", none), F.col("base"))
    return joined.select("doc_id", "print", "base", F.concat("base", extra).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans by name."""
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.encode(_named(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans give one
    replacement each for what the earlier ones left."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.sort_array(spans)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(done: Column, s: Column) -> Column:
        begin = F.greatest(done["at"], s["start"])
        piece = F.substr(text, done["at"] + 1, begin - done["at"])
        shown = F.when(s["end"] > done["at"], F.array(piece, F.get(names, s["kind"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], shown).alias("out"))

    whole = F.aggregate(
        ordered, start, add, lambda done: F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)
