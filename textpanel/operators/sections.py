"""Finding a section in a long document: all places that may begin it, a score for each, a checked end, the best one.

A document becomes a stream of places, from one pass of column expressions over its text: beginnings and the items that
may follow. A running window gives each beginning its next real end. Everything else is decided on these rows, so that a
diagnosis shows the same candidates and reasons as the choice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import MAX_SECTION, MIN_SECTION
from textpanel.functions.ranks import median
from textpanel.functions.text import is_upper, strip_tags, text_shape

#: How the section is named, and what may stand between an item and its title.
START = r"item\s*1\s*a\b[.\s:—–-]*(risk\s*factors)?"
SEPARATORS = "[.:\\-\u2014\u2013|\u2010-\u2015]*"
#: The items that may follow the section, and how their titles go on once white space is out.
ENDS = {
    "1B": (r"item\s*1\s*b\b", "(unresolvedstaff|none)"),
    "1C": (r"item\s*1\s*c\b", "cybersecurit"),
    "2": (r"item\s*2\b", "propert"),
    "3": (r"item\s*3\b", "legalproceeding"),
    "4": (r"item\s*4\b", "(minesafety|submissionofmatters|reserved)"),
    "5": (r"item\s*5\b", "market(for)?(registrant|the)"),
}
#: The language of references to a section, and of its opening.
REFERENCE_AFTER = r"(?i)\b(below|above|herein|hereof|thereof|of this|in this|to this|for further|for additional|for a more|for more|and elsewhere|contained in|included in|beginning on|set forth)\b"
REFERENCE_BEFORE = r"(?i)\b(see|refer|referred|described|discussed|disclosed|set forth|included|contained|identified|listed|under|in)\s*(in|to|under|at)?\s*$"
REFERRING = r"(?i)\b(see|refer\s+to|referred\s+to|described\s+in|discussed\s+in|disclosed\s+in|set\s+forth\s+in|included\s+in|contained\s+in|for\s+more\s+(information|detail)|for\s+(further|additional)|as\s+described|as\s+discussed|please\s+see)\b"
CONTENTS_AFTER = r"(?i)item\s*(1\s*b|1\s*c|2|3|4)\b"
CONTENTS_PAGE = r"(?i)\brisk\s*factors\s*\.{0,}\s*\d{1,3}\b"
QUOTED = r"(?i)[\"“”'']\s*risk\s*factors"
OPENING = r"(?i)\b(risk factor summary|we are subject to|you should carefully|the following|our business|an investment in|investing in|in addition to the other|before (making|investing)|careful consideration|set forth below are|described below are)\b"
#: Any place that may begin the section or name an item after it; these never overlap. All begin with one word, which is
#: looked for once at a character and by classes of them, so that most characters are passed over after one look.
ITEM = r"item\s*"
PLACE = r"[iI\u0130-\u0131][tT][eE][mM](?iU:\s*(?:" + "|".join(p.removeprefix(ITEM) for p in [START, *[p for p, _ in ENDS.values()]]) + "))"
#: Characters of text kept before and after a place, and the most pieces of text that these can lie in (a place has five characters at least).
BEFORE, AFTER = 90, 200
PIECES = 2 * AFTER // 5 + 2


def stream(docs: DataFrame, *keys: str) -> DataFrame:
    """All places of each document in order, from one pass over its text; a document without any has one row with nulls.

    (keys, ok and reason if there, n, nth, which, pos, stop, heading, before90, before80, after, near, after60, here60, here40)
    The text is taken apart at the places; their positions are sums over the parts before, and the text around them comes
    from the parts beside, so that the text itself goes no further.
    """
    carried = [c for c in ("ok", "reason") if c in docs.columns]
    apart = docs.select(*keys, *carried, F.length("text").alias("n"), F.split("text", PLACE, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(PLACE), F.lit(0)).alias("found"))
    mixed = lambda cut: F.flatten(F.transform("gaps", lambda g, i: F.array(cut(g), F.coalesce(F.get("found", i), F.lit("")))))
    apart = apart.withColumns({"heads": mixed(lambda g: F.left(g, F.lit(AFTER))), "tails": mixed(lambda g: F.right(g, F.lit(BEFORE)))})

    def place(found: Column, i: Column) -> Column:
        first = F.greatest(2 * i + 2 - PIECES, F.lit(1))
        before = F.array_join(F.slice("tails", first, 2 * i + 2 - first), "")
        return F.struct(F.length(F.get("gaps", i)).alias("gap"), found.alias("heading"), F.right(before, F.lit(BEFORE)).alias("before90"), F.left(F.array_join(F.slice("heads", 2 * i + 3, PIECES), ""), F.lit(AFTER)).alias("after"))

    rows = apart.select(*keys, *carried, "n", F.posexplode_outer(F.transform("found", place)).alias("nth", "e")).select(*keys, *carried, "n", "nth", "e.*")
    order = Window.partitionBy(*keys).orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.length("heading")).over(order).cast("int")
    which = F.when(F.col("heading").rlike(f"(?iU)^{START}"), "start")
    for k, (p, _) in ENDS.items():
        which = which.when(F.col("heading").rlike(f"(?iU)^{p}"), k)
    rows = rows.withColumns({"stop": stop, "which": which}).withColumn("pos", F.col("stop") - F.length("heading")).drop("gap")
    here = F.concat("heading", "after")
    return rows.withColumns({"before80": F.right("before90", F.lit(80)), "near": F.left("after", F.lit(30)), "after60": F.left("after", F.lit(60)), "here60": F.left(here, F.lit(60)), "here40": F.left(here, F.lit(40))})


def judged(places: DataFrame, *keys: str) -> DataFrame:
    """`places` with the verdict on each following item, and for each place the next real one after it (`end_at`)."""
    squeezed = F.regexp_replace("after60", r"(?U)[\s ]+", "")
    title = F.lit(False)
    for k, (_, t) in ENDS.items():
        title = F.when(F.col("which") == k, squeezed.rlike(f"(?i)^{SEPARATORS}{t}")).otherwise(title)
    referred = F.col("before80").rlike(REFERENCE_BEFORE) | F.col("before80").rlike(REFERRING)
    reasons = F.filter(F.array(F.when(referred, "preceded by referring language"), F.when(~title, "not followed by expected title")), lambda x: x.isNotNull())
    out = places.withColumns({"reasons": reasons, "real": (F.col("which") != "start") & ~referred & title})
    later = Window.partitionBy(*keys).orderBy(F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("end_at", F.last(F.when(F.col("real"), F.struct("pos", "which")), True).over(later))


def terminators(docs: DataFrame, *keys: str) -> DataFrame:
    """Places of following items with their verdict: real unless a reference leads to them or the expected title is missing."""
    return judged(stream(docs, *keys), *keys).where("which <> 'start'").select(*keys, "which", "pos", "stop", "reasons", "real")


def scored(places: DataFrame, *keys: str) -> DataFrame:
    """Judged places with what holds of each as a beginning: its end, length, score and the reasons for it."""
    df = places.withColumns({"section_end": F.coalesce("end_at.pos", "n"), "stop_by": F.col("end_at.which")}).withColumn("section_chars", F.col("section_end") - F.col("pos"))
    plausible = F.col("section_chars").between(MIN_SECTION, MAX_SECTION)
    rules = [
        ("toc", -100, F.col("after").rlike(CONTENTS_AFTER) | F.col("here60").rlike(CONTENTS_PAGE)),
        ("xref_after", -60, F.col("near").rlike(REFERENCE_AFTER)),
        ("xref_before", -60, F.col("before90").rlike(REFERENCE_BEFORE)),
        ("quoted", -40, F.col("here40").rlike(QUOTED)),
        ("names_section", 30, F.col("heading").rlike(r"(?i)risk\s*factors")),
        ("allcaps", 25, is_upper(F.col("heading"))),
        ("opener", 45, F.col("near").rlike(OPENING)),
        ("plausible_len", 25, plausible),
    ]
    score = F.when(F.col("after").rlike(r"^\s*[A-Z]"), 5).otherwise(0)
    for _, points, rule in rules:
        score = score + F.when(rule, points).otherwise(0)
    why = F.filter(F.array(*[F.when(rule, name) for name, _, rule in rules]), lambda x: x.isNotNull())
    return df.withColumns({"score": score, "why": why, "plausible": plausible, "start_pct": F.round(100 * F.col("pos") / F.greatest("n", F.lit(1)), 1)})


def candidates(docs: DataFrame, *keys: str) -> DataFrame:
    """Possible beginnings with end, length, score and the reasons for it."""
    df = scored(judged(stream(docs, *keys), *keys), *keys)
    return df.where("which = 'start'").select(*keys, "pos", "stop", "section_end", "stop_by", "section_chars", "score", "why", "plausible", "start_pct")


def winners(docs: DataFrame, *keys: str) -> DataFrame:
    """One row per document: the best candidate (the earliest of equals), or the reason why there is none. Unread documents keep their reason.

    Documents without any place come along in the stream, so that texts are read once.
    """
    df = scored(judged(stream(docs, *keys), *keys), *keys)
    columns = ["pos", "stop", "section_end", "stop_by", "section_chars", "score", "why", "start_pct"]
    start = F.col("which") == "start"
    best = F.max(F.when(start, F.struct(((F.col("score") > 0) & F.col("plausible")).alias("viable"), F.col("score").alias("points"), (-F.col("pos")).alias("early"), F.struct(*columns).alias("row"))))
    n = F.count_if(start)
    out = df.groupBy(*keys).agg(F.first("ok").alias("readable"), F.first("reason").alias("unread"), best.alias("best"), F.when(n > 0, n).alias("n_candidates")).select(*keys, "readable", "unread", "best.viable", "best.row.*", "n_candidates")
    reason = F.when(~F.col("readable"), F.col("unread")).when(F.col("viable").isNull(), "no_item_1a_match").when(~F.col("viable"), F.format_string("no_viable_candidate(best_score=%d,len=%d)", "score", "section_chars"))
    return out.withColumns({"ok": F.coalesce("viable", F.lit(False)), "reason": reason}).drop("readable", "unread", "viable")


def extract(docs: DataFrame, runs: DataFrame, *keys: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(runs that lie within the sections, one report row per document with the section's text and counts of runs).

    `docs` has the texts, `runs` one row per run of text with its styles, start and stop in characters of the document. Runs
    that reach over an end of the section belong to neither side; starts and stops come back from the section's beginning.
    `keep` writes a frame and reads it back, so that places are looked for once.
    """
    report = keep(winners(docs, *keys))
    found = report.where("ok").select(*[F.col(k).alias(f"_{k}") for k in keys], "pos", "section_end")
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    inside = runs.join(found, same).where("start >= pos AND stop <= section_end").withColumns({"start": F.col("start") - F.col("pos"), "stop": F.col("stop") - F.col("pos")}).drop("pos", "section_end", *[f"_{k}" for k in keys])
    styled = F.col("bold") | F.col("italic") | F.col("underline")
    counts = inside.groupBy(*keys).agg(F.count("*").alias("n_blocks"), F.count_if("bold").alias("n_bold_blocks"), F.count_if("italic").alias("n_italic_blocks"), F.count_if(styled).alias("n_styled_blocks"))
    texts = docs.select(*keys, "text").join(report.where("ok").select(*keys, "pos", "section_end"), list(keys)).select(*keys, F.substring(F.col("text"), F.col("pos") + 1, F.col("section_end") - F.col("pos")).alias("section"))
    whole = report.join(texts, list(keys), "left").join(counts, list(keys), "left")
    return inside, whole.na.fill(0, ["n_blocks", "n_bold_blocks", "n_italic_blocks", "n_styled_blocks"])


def suspicious(report: DataFrame, *keys: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(keys, reason) for sections that deserve a look; the median length is found by ranges of lengths (`keep` writes a frame and reads it back)."""
    ok = report.where("ok")
    middle = F.broadcast(median(ok, "section_chars", keep).withColumnRenamed("median", "middle"))
    n = F.col("section_chars")
    rules = F.array(
        F.when(n < 0.4 * F.col("middle"), "much shorter than median"),
        F.when(n > 2.5 * F.col("middle"), "much longer than median"),
        F.when(F.col("stop_by").isNull(), "no terminator found"),
        F.when(F.arrays_overlap("why", F.array(F.lit("xref_after"), F.lit("xref_before"))), "won despite a cross-reference penalty"),
        F.when(F.col("n_bold_blocks") < 10, "almost no styled headings"),
        F.when(F.col("score") < 50, "low confidence score"),
    )
    return ok.crossJoin(middle).select(*keys, F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("reason"))


def by_reason(flags: DataFrame, key: str, first: int = 10) -> DataFrame:
    """Members by reason, details behind a second colon left off."""
    short = flags.select(F.substring_index("reason", ":", 2).alias("reason"), key)
    shown = short.withColumn("nth", F.row_number().over(Window.partitionBy("reason").orderBy(key))).where(F.col("nth") <= first)
    members = shown.groupBy("reason").agg(F.array_sort(F.collect_list(key)).alias("members"))
    return short.groupBy("reason").agg(F.count("*").alias("n")).join(members, "reason")


def page_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Markup counts of each page, without reading its structure."""
    h = F.coalesce(F.col(html), F.lit(""))
    df = pages.withColumn("plain", strip_tags(h))
    count = lambda p: F.regexp_count(h, F.lit(p))
    out = {"chars_html": F.length(h), "chars_text": F.length("plain"), "n_tables": count(r"(?i)<table[\s>]"), "n_headings": count(r"(?i)<h[1-6][\s>]"), "n_bold": count(r"(?i)<(b|strong)[\s>]"), "inline_xbrl": h.rlike(r"(?i)<ix:|xmlns:ix=")}
    out |= {f"n_{k}": F.regexp_count("plain", F.lit(f"(?i){p}")) for k, p in {"1A": r"item\s*1\s*a\b", "1B": r"item\s*1\s*b\b", "1C": r"item\s*1\s*c\b", "2": r"item\s*2\b"}.items()}
    df = df.withColumns(out)
    return df.withColumn("markup_ratio", F.round(1 - F.col("chars_text") / F.greatest("chars_html", F.lit(1)), 3)).drop(html, "plain")


def item_gaps(docs: DataFrame, *keys: str) -> DataFrame:
    """For each document the relative places of the first twelve beginnings, and the distance from the last one to the next 1B, 1C and 2."""
    start = F.col("which") == "start"
    last = F.max(F.when(start, F.col("pos"))).over(Window.partitionBy(*keys))
    df = stream(docs, *keys).withColumn("last", last).where("last is not null")
    share = F.round(100 * F.col("pos") / F.greatest("n", F.lit(1)), 1)
    of = lambda value: F.array_sort(F.collect_list(F.when(start, F.struct("pos", value.alias("v")))))
    nearest = [F.min(F.when((F.col("which") == k) & (F.col("pos") > F.col("last")), F.col("pos") - F.col("last"))).alias(k) for k in ("1B", "1C", "2")]
    out = df.groupBy(*keys).agg(F.first("last").alias("last"), of(share).alias("pos_1A"), *nearest, of(F.left(F.concat("heading", "after60"), F.lit(90))).alias("ctx_1A"))
    return out.withColumns({"pos_1A": F.slice(F.transform("pos_1A", lambda x: x["v"]), 1, 12), "ctx_1A": F.slice(F.transform("ctx_1A", lambda x: x["v"]), 1, 8)})


def heading_profile(runs: DataFrame, *keys: str, rich: int = 20) -> tuple[DataFrame, DataFrame]:
    """(strategy per document by its bold runs, shapes of bold runs in rich and in poor documents with their share)."""
    per = runs.groupBy(*keys).agg(F.count("*").alias("n_blocks"), F.count_if("bold").alias("n_bold_blocks")).withColumn("strategy", F.when(F.col("n_bold_blocks") >= rich, "bold").otherwise("NEEDS_FALLBACK"))
    shapes = runs.where("bold").join(per.select(*keys, "strategy"), list(keys)).groupBy("strategy", text_shape(F.col("text")).alias("shape")).agg(F.count("*").alias("n"))
    share = F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy("strategy")), 1)
    return per, shapes.withColumn("share", share)
