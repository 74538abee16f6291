"""Word similarity on trigrams, as built-in expressions.

A text is lower-cased and split into alphanumeric words, each padded with two
spaces before and one after; its trigrams are taken in order.  The word
similarity of a query and a text is the greatest similarity (shared trigrams over
all) between the query's trigrams and any run of the text's trigrams.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaguespark.functions import coerce

THRESHOLD = 0.6


def trigrams(text: Column) -> Column:
    """The trigrams of a text in order, repeated ones kept."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.flatten(F.transform(words, grams))


def word_similarity(query: Column, text: Column) -> Column:
    """Between 0 and 1; 0 without trigrams on either side, null for null.

    Only runs that start and end with a shared trigram can be the best ones.
    """

    def best(wanted: Column, grams: Column) -> Column:
        marks = F.transform(grams, lambda g, i: F.struct(i.alias("i"), F.array_contains(wanted, g).alias("hit")))
        at = F.transform(F.filter(marks, lambda m: m["hit"]), lambda m: m["i"])

        def score(start: Column, end: Column) -> Column:
            run = F.array_distinct(F.slice(grams, start + 1, end - start + 1))
            return coerce.let(F.size(F.array_intersect(wanted, run)), lambda common: common / (F.size(wanted) + F.size(run) - common))

        scores = lambda places: F.flatten(F.transform(places, lambda s: F.transform(F.filter(places, lambda e: e >= s), lambda e: score(s, e))))
        return F.array_max(coerce.let(at, scores))

    # Trigrams are cut once a pair, not once a run.
    found = coerce.let(F.struct(F.array_distinct(trigrams(query)).alias("w"), trigrams(text).alias("g")), lambda x: best(x["w"], x["g"]))
    return F.when(query.isNull() | text.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(found, F.lit(0.0)))


def may_match(query: Column, text: Column, threshold: float = THRESHOLD) -> Column:
    """A cheap necessary condition for a similarity above the threshold: the text holds more than that share of the query's trigrams."""
    wanted = F.array_distinct(trigrams(query))
    return F.size(F.array_intersect(wanted, trigrams(text))) > threshold * F.size(wanted)
