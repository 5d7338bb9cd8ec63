"""From the styled runs of a section to its records: furniture out, runs merged, labelled, summary out, records assembled.

Runs are rows (keys, idx, text, bold, italic, underline, font_size, start); each step is a window over a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import HEADER_REPEATS, MAX_CATEGORY, MAX_HEADING, MIN_BODY, SUMMARY_SHARE
from textpanel.functions.text import is_upper, word_count

#: Page numbers, what stands at the edge of pages, and how summaries are headed.
PAGE_NUMBER = r"^\d{1,4}\.?$"
FURNITURE = r"(?i)^(table of contents|index|back to contents|form\s*10-k|part\s+[ivx]+\b|annual report( on form 10-k)?|glossary of (acronyms|terms))\W*$"
RUNNING = r"(?i)(form\s*10-k|\|\s*\d+\s*$|^\s*\d+\s*\|)"
CORPORATE = r"(?i)\b(inc|corp|corporation|bancorp|bancshares|company|financial|holdings|n\.a|form\s*10-k)\b"
SUMMARY = r"(?i)^\s*(item\s*1\s*a\b[.:\-—–\s]*(risk\s*factors?\b)?[.:\-—–\s]*)?(risk\s*factors?\s+summary|summary\s+of\s+(material\s+)?risk\s*factors?|summary\s+of\s+(our\s+)?(principal|material|key)\s+risks?)\b"
SECTION = r"(?i)^item\s*1\s*a\b"
GOES_ON = r"^\s*([a-z]|[,.;:)\]]|and\b|or\b|in\b|of\b|for\b|to\b)"


def styled() -> Column:
    return F.col("bold") | F.coalesce("italic", F.lit(False)) | F.coalesce("underline", F.lit(False))


def header_shaped(t: Column) -> Column:
    """Several words, not a sentence (unless it begins with a number), with a digit or a corporate form."""
    words = word_count(t)
    sentence = F.rtrim(t).rlike(r"[.?!:;]$") & ~t.rlike(r"^\s*\d")
    return words.between(3, 8) & F.length(t).between(15, 60) & ~sentence & (t.rlike(r"\d") | t.rlike(CORPORATE))


def furniture(runs: DataFrame, keys: list[str], repeats: int = HEADER_REPEATS) -> DataFrame:
    """`runs` with `is_furniture`. Running headers are found by how often they occur with their digits made equal."""
    df = runs.withColumn("text", F.trim("text")).withColumn("shaped", header_shaped(F.col("text"))).withColumn("form", F.lower(F.regexp_replace("text", r"\d+", "#")))
    same = F.count_if("shaped").over(Window.partitionBy(*keys, "form"))
    t = F.col("text")
    edge = t.rlike(PAGE_NUMBER) | t.rlike(FURNITURE) | t.rlike(r"(?U)^[\W_]*$") | ((F.length(t) <= 90) & t.rlike(RUNNING)) | (F.col("shaped") & (same >= repeats))
    return df.withColumn("is_furniture", edge).drop("shaped", "form")


def merge_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours of one style joined: unstyled ones always, styled ones only where the second goes on from the first."""
    w = Window.partitionBy(*keys).orderBy("idx")
    style = F.struct("bold", F.coalesce("italic", F.lit(False)).alias("i"), F.coalesce("underline", F.lit(False)).alias("u"), F.coalesce("font_size", F.lit(-1.0)).alias("s"))
    df = runs.withColumns({"style": style, "styled": styled()})
    df = df.withColumns({"prev_style": F.lag("style").over(w), "prev_text": F.lag("text").over(w)})
    t, p = F.col("text"), F.col("prev_text")
    goes_on = (F.length(t) == 0) | t.rlike(r"^[.,;:)\]!?]") | t.rlike(r"^\p{Ll}") | ((F.length(t) < 15) & ~t.rlike(r"^\p{L}")) | F.rtrim(p).rlike(r"[(\-\[—–]$")
    new = F.col("prev_style").isNull() | (F.col("prev_style") != F.col("style")) | (F.col("styled") & ~goes_on)
    gap = F.when(new | t.rlike(r"^[.,;:)\]]") | p.rlike(r"[(\-\[]$"), "").otherwise(" ")
    df = df.withColumns({"part": F.concat(gap, t), "island": F.sum(new.cast("int")).over(w)})
    merged = df.groupBy(*keys, "island").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "part"))), lambda x: x["part"]), "").alias("text"), F.first("styled").alias("styled"), F.min("start").alias("start"))
    return merged.withColumnRenamed("island", "idx").withColumn("text", F.trim("text"))


def labelled(merged: DataFrame, keys: list[str]) -> DataFrame:
    """`label`: CATEGORY, RISK, BODY or DROP, from a run and the one after it."""
    w = Window.partitionBy(*keys).orderBy("idx")
    df = merged.withColumns({"next_text": F.lead("text").over(w), "next_styled": F.lead("styled").over(w)})
    t, n = F.col("text"), F.length("text")
    before_prose = F.coalesce(~F.col("next_styled") & (F.length("next_text") >= MIN_BODY), F.lit(False))
    before_heading = F.coalesce("next_styled", F.lit(False))
    goes_on = F.coalesce(F.col("next_text").rlike(GOES_ON), F.lit(False))
    label = (
        F.when(~F.col("styled") | (n > MAX_HEADING), "BODY")
        .when(t.rlike(SECTION), "DROP")
        .when((n <= MAX_CATEGORY) & before_heading & ~t.endswith("."), "CATEGORY")
        .when((n <= MAX_CATEGORY) & is_upper(t), "CATEGORY")
        .when(before_prose & ~goes_on, "RISK")
        .otherwise("BODY")
    )
    return df.withColumn("label", label).drop("next_text", "next_styled")


def without_summary(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Labels of the summary block turned to DROP, `in_summary` set: from its heading to the first heading in the form of a sentence, looked for in the first part of the document only."""
    w = Window.partitionBy(*keys)
    t = F.col("text")
    label_like = (word_count(t) <= 6) & ~F.rtrim(t).rlike(r"[.?!]$")
    df = runs.withColumns({"nth": F.row_number().over(w.orderBy("idx")) - 1, "n_runs": F.count("*").over(w)})
    df = df.withColumn("first", F.min(F.when(t.rlike(SUMMARY), F.col("nth"))).over(w))
    limit = F.least("n_runs", F.greatest(F.floor(F.col("n_runs") * SUMMARY_SHARE), F.col("first") + 2))
    real = (F.col("nth") > F.col("first")) & (F.col("nth") < limit) & F.col("label").isin("RISK", "CATEGORY") & ~label_like
    df = df.withColumn("last", F.coalesce(F.min(F.when(real, F.col("nth"))).over(w), F.col("first") + 1))
    inside = F.coalesce((F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("last")), F.lit(False))
    return df.withColumns({"in_summary": inside, "label": F.when(inside, "DROP").otherwise(F.col("label"))}).drop("nth", "n_runs", "first", "last")


def assemble(runs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, risk_index, heading, category, body, chars, start_char): a RISK opens a record, later text belongs to it; a CATEGORY holds from where it stands on without closing the record."""
    w = Window.partitionBy(*keys).orderBy("idx")
    df = runs.where("label <> 'DROP'").withColumns({"category": F.last(F.when(F.col("label") == "CATEGORY", F.col("text")), ignorenulls=True).over(w), "record": F.sum(F.when(F.col("label") == "RISK", 1).otherwise(0)).over(w)})
    df = df.where("record > 0 AND label <> 'CATEGORY'")
    head = F.col("label") == "RISK"
    bodies = F.filter(F.array_sort(F.collect_list(F.when(~head, F.struct("idx", "text")))), lambda x: x.isNotNull())
    out = df.groupBy(*keys, "record").agg(F.max(F.when(head, F.col("text"))).alias("heading"), F.max(F.when(head, F.col("category"))).alias("category"), F.trim(F.array_join(F.transform(bodies, lambda x: x["text"]), " ")).alias("body"), F.max(F.when(head, F.col("start"))).alias("start_char"))
    return out.select(*keys, (F.col("record") - 1).cast("int").alias("risk_index"), "heading", "category", "body", (F.length("heading") + F.length("body")).alias("chars"), "start_char")


def steps(runs: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    marked = furniture(runs, keys)
    merged = merge_runs(marked.where("NOT is_furniture"), keys)
    labels = without_summary(labelled(merged, keys), keys)
    return {"furniture": marked, "merged": merged, "labels": labels, "records": assemble(labels, keys)}


def split(runs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, one report row per document)."""
    s = steps(runs, keys)
    marked = s["furniture"].groupBy(*keys).agg(F.count_if("is_furniture").alias("furniture_dropped"))
    labels = s["labels"].groupBy(*keys).agg(F.count("*").alias("runs_after_merge"), F.count_if("in_summary").alias("summary_runs_dropped"))
    records = s["records"].groupBy(*keys).agg(F.count("*").alias("n_risks"), F.countDistinct("category").alias("n_categories"), F.count_if(F.length("body") < MIN_BODY).alias("short_bodies"), F.median("chars").alias("median_risk_chars"))
    report = marked.join(labels, keys, "left").join(records, keys, "left").na.fill(0)
    few = F.filter(F.array(F.when(F.col("n_risks") < 15, "few"), F.when(F.col("n_risks") > 70, "many"), F.when(F.col("short_bodies") > 0.2 * F.col("n_risks"), "short bodies")), lambda x: x.isNotNull())
    return s["records"], report.withColumns({"has_risk_summary": F.col("summary_runs_dropped") > 0, "flagged": F.array_join(few, ";")})


def extremes(report: DataFrame, columns: dict[str, Column], *keys: str, n: int = 10) -> DataFrame:
    """(kind, rank, keys): for each kind the first n documents in the order of its column, ties by key."""
    out = None
    for kind, order in columns.items():
        first = report.orderBy(order, *keys).limit(n)
        one = first.select(F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(order, *keys)).alias("rank"), *keys)
        out = one if out is None else out.unionByName(one)
    return out
