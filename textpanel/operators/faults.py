"""Faults planted in copies of the inputs, and the checks that ought to notice them.

An injector takes the input frames by name and returns them changed. The sound inputs and all damaged ones are checked
together, each under its name; comparing the values of sound and damaged copies tells what noticed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import MIN_BODY, MIN_HEADING
from textpanel.functions.stats import relative_change

Inputs = dict[str, DataFrame]


def _filing(records: DataFrame, place: int) -> DataFrame:
    """The filing at a place of the order by company and year."""
    return records.select("cik", "fiscal_year").distinct().orderBy(F.col("cik").cast("string"), "fiscal_year").limit(place + 1).orderBy(F.desc(F.col("cik").cast("string")), F.desc("fiscal_year")).limit(1).withColumn("hit", F.lit(True))


def _marked(records: DataFrame, place: int) -> DataFrame:
    return records.join(F.broadcast(_filing(records, place)), ["cik", "fiscal_year"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def truncate_filing(x: Inputs) -> Inputs:
    size = F.count("*").over(Window.partitionBy("cik", "fiscal_year"))
    r = _marked(x["records"], 0).withColumn("size", size).where(~F.col("hit") | (F.col("risk_index") < F.floor(F.col("size") / 2)))
    return x | {"records": r.drop("hit", "size")}


def empty_bodies(x: Inputs) -> Inputs:
    blank = F.col("hit") & (F.col("risk_index") < 10)
    r = _marked(x["records"], 1).withColumns({"body": F.when(blank, "").otherwise(F.col("body")), "chars": F.when(blank, F.length("heading")).otherwise(F.col("chars"))})
    return x | {"records": r.drop("hit")}


def duplicate_rows(x: Inputs) -> Inputs:
    r = _marked(x["records"], 2)
    size = F.count("*").over(Window.partitionBy("cik", "fiscal_year"))
    again = r.withColumn("size", size).where("hit AND risk_index < 5").withColumn("risk_index", (F.col("risk_index") + F.col("size")).cast(r.schema["risk_index"].dataType))
    again = again.withColumn("risk_id", F.concat("risk_id", F.lit("_again"))).drop("size")
    return x | {"records": r.unionByName(again).drop("hit")}


def corrupt_document(x: Inputs) -> Inputs:
    """A filing's file can't be read: its records are gone, and a row says so."""
    r = _marked(x["records"], 3)
    lost = r.where("hit").select(F.format_string("unreadable %s_FY%s.json", F.col("cik").cast("string"), F.col("fiscal_year").cast("string")).alias("error")).distinct()
    return x | {"records": r.where("NOT hit").drop("hit"), "unreadable": x["unreadable"].unionByName(lost)}


def empty_classification(x: Inputs, n: int = 500) -> Inputs:
    first = x["categories"].orderBy("risk_id").limit(n).select("risk_id", F.lit(True).alias("hit"))
    c = x["categories"].join(first, "risk_id", "left").withColumn("category", F.when(F.col("hit"), "").otherwise(F.col("category"))).drop("hit")
    return x | {"categories": c}


def shifted_labels(x: Inputs) -> Inputs:
    """Every category moves to the row before it, the first one to the last: counts stay, every label is wrong.

    The order runs over companies one by one, so that no window holds all rows: each company's last row takes the first
    label of the next company.
    """
    c = x["categories"].withColumn("part", F.pmod(F.xxhash64("risk_id"), F.lit(64)))
    w = Window.partitionBy("part").orderBy("risk_id")
    first = c.groupBy("part").agg(F.min_by("category", "risk_id").alias("head"))
    order = Window.orderBy("part")
    after = first.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_head"))
    moved = c.withColumn("next", F.lead("category").over(w)).withColumn("is_last", F.lead("risk_id").over(w).isNull()).join(F.broadcast(after), "part")
    return x | {"categories": moved.withColumn("category", F.when(F.col("is_last"), F.col("next_head")).otherwise(F.col("next"))).drop("part", "next", "next_head", "is_last")}


def broken_match_ids(x: Inputs, n: int = 50) -> Inputs:
    first = x["matches"].where("prev_id IS NOT NULL AND prev_id <> ''").orderBy("prev_id", "curr_id").limit(n).select("prev_id", F.lit(True).alias("hit")).distinct()
    m = x["matches"].join(first, "prev_id", "left").withColumn("prev_id", F.when(F.col("hit"), F.concat("prev_id", F.lit("_GHOST"))).otherwise(F.col("prev_id"))).drop("hit")
    return x | {"matches": m.select(x["matches"].columns)}


def wrong_fiscal_year(x: Inputs) -> Inputs:
    r = _marked(x["records"], 5)
    return x | {"records": r.withColumn("fiscal_year", F.when(F.col("hit"), 2099).otherwise(F.col("fiscal_year"))).drop("hit").select(x["records"].columns)}


FAULTS: dict[str, Callable[[Inputs], Inputs]] = {
    "truncate_filing": truncate_filing,
    "empty_bodies": empty_bodies,
    "duplicate_rows": duplicate_rows,
    "corrupt_json": corrupt_document,
    "empty_classification": empty_classification,
    "shifted_labels": shifted_labels,
    "broken_match_ids": broken_match_ids,
    "wrong_fiscal_year": wrong_fiscal_year,
}


#: What the checks read of each input.
READ = {"records": ["risk_id", "cik", "fiscal_year", "risk_index", "heading", "body"], "categories": ["risk_id", "category"], "matches": ["prev_id"], "unreadable": ["error"]}
METRICS = ("missing_category", "orphan_prior_risk", "risk_factors", "min_risks_per_filing", "filings")
SOUND = "sound"


def checks(x: Inputs, copies: list[str], keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(fault, kind, name, value) of errors, quarantined records (each under its first reason only) and metrics of each copy.

    The inputs hold all copies, told apart by the column fault, so that one pass serves them all. `keep` may write the
    judged records, ids and reasons without texts, which several checks read.
    """
    plain = F.when(F.length(F.trim(F.coalesce("heading", F.lit("")))) < MIN_HEADING, "empty_heading").when(F.length(F.coalesce("body", F.lit(""))) < MIN_BODY, "short_body")
    r = x["records"].withColumn("reason", plain)
    nth = F.row_number().over(Window.partitionBy("fault", "cik", "fiscal_year", "heading", F.col("reason").isNull()).orderBy("risk_index"))
    r = keep(r.withColumn("reason", F.coalesce("reason", F.when(nth > 1, "duplicate_heading_in_filing"))).select("fault", "risk_id", "cik", "fiscal_year", "reason"))
    kept = r.where("reason IS NULL")
    ids = kept.select("fault", "risk_id")
    named = x["categories"].where("coalesce(category, '') <> ''").select("fault", "risk_id").distinct()
    pointers = x["matches"].where("coalesce(prev_id, '') <> ''").select("fault", F.col("prev_id").alias("risk_id"))
    filings = kept.groupBy("fault", "cik", "fiscal_year").agg(F.count("*").alias("n"))
    n = F.count("*")

    def values(kind: str, name, df: DataFrame, value=n) -> DataFrame:
        return df.groupBy("fault", F.lit(kind).alias("kind"), name.alias("name")).agg(value.cast("double").alias("value"))

    def metric(name: str, df: DataFrame, value=n) -> DataFrame:
        return values("metric", F.lit(name), df, value)

    nothing = r.sparkSession.createDataFrame([(c, "metric", m, 0.0) for c in copies for m in METRICS], "fault string, kind string, name string, value double")
    parts = [
        values("error", F.col("error"), x["unreadable"]),
        values("error", F.concat(F.lit("fiscal year outside plausible range: "), F.col("fiscal_year").cast("string")), kept.where(~F.col("fiscal_year").between(2000, 2030))),
        values("quarantine", F.col("reason"), r.where("reason IS NOT NULL")),
        metric("missing_category", ids.join(named, ["fault", "risk_id"], "left_anti")),
        metric("orphan_prior_risk", pointers.join(ids, ["fault", "risk_id"], "left_anti")),
        metric("risk_factors", kept),
        metric("min_risks_per_filing", filings, F.min("n")),
        metric("filings", filings),
        nothing,
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("fault", "kind", "name").agg(F.max("value").alias("value"))


def signals(values: DataFrame) -> DataFrame:
    """(fault, kind, name, before, after) of what noticed: new errors, more quarantined, metrics that moved by over two percent or from nothing.

    What the sound copy has and a damaged one lacks is no signal, save for metrics, which every copy has.
    """
    before = values.where(F.col("fault") == SOUND).select("kind", "name", F.col("value").alias("before"))
    after = values.where(F.col("fault") != SOUND).withColumnRenamed("value", "after")
    both = after.join(before, ["kind", "name"], "left").na.fill(0.0, ["before"])
    b, a = F.col("before"), F.col("after")
    fired = F.when(F.col("kind") == "error", (b == 0) & (a > 0)).when(F.col("kind") == "quarantine", a > b).otherwise(F.when(b > 0, relative_change(b, a) > 0.02).otherwise(a > 0))
    return both.where(fired).select("fault", "kind", "name", "before", "after")


def run(inputs: Inputs, names: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(fault, kind, name, before, after) of the signals that each fault sets off; a fault that nothing notices has one row of nulls."""
    faults = list(names or FAULTS)
    copies = {SOUND: inputs} | {f: FAULTS[f](inputs) for f in faults}
    x = {part: reduce(lambda a, b: a.unionByName(b), [c[part].select(F.lit(f).alias("fault"), *columns) for f, c in copies.items()]) for part, columns in READ.items()}
    told = signals(keep(checks(x, list(copies), keep)))
    return inputs["records"].sparkSession.createDataFrame([(f,) for f in faults], "fault string").join(told, "fault", "left")
