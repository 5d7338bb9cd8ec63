"""Column expressions on text: tokens, shapes, patterns and names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_words(text: Column) -> Column:
    """Runs of a-z of the lower-cased text; digits and punctuation only separate."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def with_bigrams(words: Column) -> Column:
    """The words, then each pair of neighbours as `a_b`."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit("_"), b))
    return F.when(n >= 2, F.concat(words, pairs)).otherwise(words)


def grams(text: Column) -> Column:
    return with_bigrams(letter_words(F.coalesce(text, F.lit(""))))


def word_count(text: Column) -> Column:
    """Words between white space of any kind; 0 for a blank text."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"(?U)\s+")))


def is_upper(text: Column) -> Column:
    """At least one cased letter, and none of them small."""
    return (F.upper(text) == text) & (F.lower(text) != text)


def squash(text: Column) -> Column:
    """White space of any kind, no-break and thin spaces included, to single blanks."""
    return F.regexp_replace(text, r"(?U)[\s  -​  　]+", " ")


def strip_tags(html: Column) -> Column:
    """A quick text of a page: scripts and styles out, tags to blanks, three entities, white space squashed."""
    t = F.regexp_replace(html, r"(?is)<(script)[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<(style)[^>]*>.*?</style>", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    t = F.replace(F.replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&")), F.lit("&#160;"), F.lit(" "))
    return F.regexp_replace(t, r"[ \t\n\r\f\x0b ]+", " ")


#: Corporate forms that a registrant's name may end with.
SUFFIXES = ("NATIONAL ASSOCIATION", "INCORPORATED", "CORPORATION", "COMPANY", "HOLDINGS", "HOLDING", "CORP", "INC", "LLC", "LTD", "CO", "NA", "ET AL")


def name_key(name: Column) -> Column:
    """What stays of a company name without state suffixes at its end, punctuation and corporate forms."""
    n = F.regexp_replace(F.upper(name), r"(/[A-Z]{2,4}/?\s*)+$", "")
    n = F.trim(F.regexp_replace(F.regexp_replace(n, "[^A-Z0-9 ]", " "), " +", " "))
    return F.regexp_replace(n, f"( ({'|'.join(SUFFIXES)}))+$", "")


def fiscal_year(period_end: Column) -> Column:
    """The year of a period that ends in July to December, else the year before. `period_end` is an ISO date string; anything else has no year."""
    year, month = F.substring(period_end, 1, 4).try_cast("int"), F.substring(period_end, 6, 2).try_cast("int")
    return F.when(month >= 7, year).otherwise(year - 1)


def keyword_pattern(term: str, edge: str = r"(?U)\b") -> str:
    """A pattern that finds `term` at the beginning of a word; blanks in it stand for any white space."""
    return edge + r"\s+".join(re.escape(x) for x in term.split(" "))


def trie_pattern(terms: list[str]) -> str:
    """One pattern for all terms, each letter of their common beginnings once; it matches the longest term that begins at a place."""

    def node(of: set[str]) -> str:
        branches: dict[str, set[str]] = {}
        for t in of - {""}:
            branches.setdefault(t[0], set()).add(t[1:])
        below = [(r"\s+" if c == " " else re.escape(c)) + node(rest) for c, rest in sorted(branches.items())]
        if not below:
            return ""
        return "(?:" + "|".join(below) + ")" + "?" * ("" in of)

    return node(set(terms))


SHAPE_PAGE = r"^\d{1,4}$"
SHAPE_FURNITURE = r"(?i)^(table of contents|index|part\s+[ivx]+|form\s+10-k|annual report|glossary|back to contents)\b"


def text_shape(text: Column) -> Column:
    """The rough shape of a run of text, for counting."""
    return (
        F.when(text.rlike(SHAPE_PAGE), "page_number")
        .when(text.rlike(SHAPE_FURNITURE), "furniture")
        .when(F.length(text) < 4, "tiny")
        .when(is_upper(text), "ALL_CAPS")
        .when(F.length(text) > 400, "long_paragraph")
        .when(text.rlike(r"[.?!]$"), "sentence_heading")
        .otherwise("short_phrase")
    )


def archive_url(base: str, cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit(base), F.lit("/"), cik.cast("long").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def record_id(cik: Column, year: Column, index: Column) -> Column:
    """`<cik>_FY<year>_<index in three digits>`."""
    digits = index.cast("string")
    return F.concat(cik.cast("string"), F.lit("_FY"), year.cast("string"), F.lit("_"), F.lpad(digits, F.greatest(F.length(digits), F.lit(3)), F.lit("0")))
