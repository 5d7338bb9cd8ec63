"""Keyword scores: three points for each hit in the heading, one for each in the body; the highest sum names the category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.constants import KEYWORD_WEIGHTS, KEYWORDS, TIE_CATEGORY
from textpanel.functions.text import keyword_pattern, trie_pattern

#: The beginning of a word.
EDGE = r"(?U)\b"


def overlaps_itself(term: str) -> bool:
    """True for terms that may begin anew inside their own hit, such as `a a`; of these, hits that overlap count once."""
    return any(term.startswith(term[i:]) for i in range(1, len(term)) if not (term[i - 1].isalnum() and term[i].isalnum()))


def beginnings(text: Column, terms: list[str], edge: str) -> Column:
    """The longest term at each beginning of a word where one stands, in order, with single blanks: one pass over the text.

    Of the other terms, those at the same place are its beginnings.
    """
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"{edge}(?=({trie_pattern(terms)}))"), F.lit(1))
    flags = "(?U)" if edge.startswith("(?U)") else ""
    return F.transform(found, lambda x: F.regexp_replace(x, flags + r"\s+", " "))


def tallies(text: Column, groups: dict[str, list[str]], edge: str = EDGE) -> Column:
    """A map's worth of counts as an array, one for each group of terms in order: how often its terms occur, each counted for itself."""
    lowered = {g: [t.lower() for t in terms] for g, terms in groups.items()}
    plain = {g: [t for t in terms if t and not overlaps_itself(t)] for g, terms in lowered.items()}
    every = sorted({t for terms in plain.values() for t in terms})
    zero = F.array(*[F.lit(0)] * len(groups))
    if every:
        # A group may list a term twice; it counts as often.
        worth = {t: [sum(t.startswith(x) for x in plain[g]) for g in groups] for t in every}
        table = F.create_map(*[x for t in every for x in (F.lit(t), F.array(*[F.lit(n) for n in worth[t]]))])
        counts = F.aggregate(beginnings(text, every, edge), zero, lambda a, t: F.zip_with(a, F.element_at(table, t), lambda x, y: x + y))
    else:
        counts = zero
    odd = {g: [t for t in terms if t and overlaps_itself(t)] for g, terms in lowered.items()}
    if not any(odd.values()):
        return counts
    lower = F.lower(F.coalesce(text, F.lit("")))
    own = F.array(*[sum((F.regexp_count(lower, F.lit(keyword_pattern(t, edge))) for t in terms), F.lit(0)) for terms in odd.values()])
    return F.zip_with(counts, own, lambda x, y: x + y)


def hits(text: Column, terms: list[str], edge: str = EDGE) -> Column:
    """How often the terms occur, each counted for itself: a longer term and its beginning both count."""
    return tallies(text, {"all": terms}, edge)[0]


def classify(records: DataFrame, keywords: dict[str, list[str]] | None = None, heading: str = "heading", body: str = "body", edge: str = EDGE) -> DataFrame:
    """`records` with a score per category, the category (ties go to the preferred one if it is among them, else to the first by name) and the margin to the second.

    Each field is read once for all categories' terms.
    """
    keywords = keywords or KEYWORDS
    high, low = KEYWORD_WEIGHTS
    scored = records.withColumns({"in_heading": tallies(F.col(heading), keywords, edge), "in_body": tallies(F.col(body), keywords, edge)})
    scored = scored.withColumns({f"score_{c}": (high * F.col("in_heading")[i] + low * F.col("in_body")[i]).cast("long") for i, c in enumerate(keywords)}).drop("in_heading", "in_body")
    order = sorted(keywords, key=lambda c: (c != TIE_CATEGORY, c))
    ranked = F.array_sort(F.array(*[F.struct((-F.col(f"score_{c}")).alias("s"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(order)]))
    scored = scored.withColumn("ranked", ranked)
    return scored.withColumns({"category": F.col("ranked")[0]["c"], "margin": F.col("ranked")[1]["s"] - F.col("ranked")[0]["s"]}).drop("ranked")


def frequencies(classified: DataFrame, column: str = "category") -> DataFrame:
    """(value, n, share) of a column, most frequent first."""
    counts = classified.groupBy(column).agg(F.count("*").alias("n"))
    total = classified.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 1).alias("share")).orderBy(F.desc("n"), column)
