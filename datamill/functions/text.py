"""Word lists and token expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The common English stop words, one list in alphabetical order.
STOP_WORDS = """
a about above after again against all am an and any are aren't as at
be because been before being below between both but by
can't cannot could couldn't
did didn't do does doesn't doing don't down during
each
few for from further
had hadn't has hasn't have haven't having he he'd he'll he's her here here's hers herself
him himself his how how's
i i'd i'll i'm i've if in into is isn't it it's its itself
let's
me more most mustn't my myself
no nor not
of off on once only or other ought our ours ourselves out over own
same shan't she she'd she'll she's should shouldn't so some such
than that that's the their theirs them themselves then there there's these they they'd
they'll they're they've this those through to too
under until up
very
was wasn't we we'd we'll we're we've were weren't what what's when when's where where's
which while who who's whom why why's with won't would wouldn't
you you'd you'll you're you've your yours yourself yourselves
""".split()

# A run of letters and digits, with apostrophes inside, so that contractions stay whole.
TOKEN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"


def kept_terms(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of the text that are longer than two, all letters, no stop words.

    A contraction is held against the stop words whole, and is no term of its own.
    """
    words = F.regexp_extract_all(F.replace(F.lower(text), F.lit("’"), F.lit("'")), F.lit(TOKEN), F.lit(0))
    stops = sorted(set(stop_words))

    def is_term(word: Column) -> Column:
        letters = word.rlike(r"^\p{L}{3,}$")
        return letters & ~word.isin(stops) if stops else letters

    return F.filter(words, is_term)


def strip_tags(markup: Column) -> Column:
    """Markup without tags, runs of blanks made one, ends trimmed."""
    bare = F.regexp_replace(markup, "<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))


def between_tags(markup: Column, tag: str) -> Column:
    """Contents of the first `<tag …>…</tag>`, empty when there is none."""
    return F.regexp_extract(markup, f"(?s)<{tag}(?: [^>]*)?>(.*?)</{tag}>", 1)


def tag_fragments(markup: Column, tag: str) -> Column:
    """Every `<tag …>…</tag>` of a text with its tags, in order."""
    return F.regexp_extract_all(markup, F.lit(f"(?s)<{tag}(?: [^>]*)?>.*?</{tag}>"), F.lit(0))


def tag_attribute(markup: Column, tag: str, name: str) -> Column:
    """Value of an attribute of the first such tag, empty when it is not there."""
    return F.regexp_extract(markup, f'<{tag}(?: [^>]*)? {name}="([^"]*)"', 1)
