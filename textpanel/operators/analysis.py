"""The analysts' questions over the warehouse, theme signals, and the dashboard's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import LABELS, MATCH_MIN, SIGNALS, THEMES
from textpanel.functions.stats import percent, wilson_high, wilson_low


def _panel(dim_company: DataFrame) -> DataFrame:
    return F.broadcast(dim_company.agg(F.count("*").alias("panel")))


def headline_by_year(facts: DataFrame, dim_company: DataFrame, pattern: str = THEMES["deposits"]) -> DataFrame:
    """Companies that newly disclose a theme, by year."""
    hits = facts.where((F.col("yoy_label") == "NEW") & F.lower("heading").rlike(pattern))
    by_year = hits.groupBy("fiscal_year").agg(F.countDistinct("cik").alias("companies"), F.count("*").alias("risk_factors"))
    return by_year.crossJoin(_panel(dim_company)).select("fiscal_year", "companies", percent(F.col("companies"), F.col("panel")).alias("pct_of_panel"), "risk_factors").orderBy("fiscal_year")


def theme_control(facts: DataFrame, themes: DataFrame, years: tuple[int, ...] = (2022, 2023, 2024, 2025)) -> DataFrame:
    """Companies with a new record of each theme, by year; themes without any keep their row. `themes` is (theme, pattern), a few rows."""
    hits = facts.where("yoy_label = 'NEW'").select("cik", "fiscal_year", F.lower("heading").alias("h"))
    # Facts are streamed past the broadcast themes once; themes without a hit come back at the end.
    found = hits.join(F.broadcast(themes), F.expr("h rlike pattern"))
    # Companies are bits: distinct ones are counted exactly, year by year, in one aggregation and without copies of the rows.
    bits = {f"fy{y}": F.bitmap_count(F.bitmap_construct_agg(F.when(F.col("fiscal_year") == y, F.bitmap_bit_position(F.col("cik").cast("long"))))) for y in years}
    found = found.groupBy("theme", F.bitmap_bucket_number(F.col("cik").cast("long")).alias("bucket")).agg(*[n.alias(k) for k, n in bits.items()])
    found = found.groupBy("theme").agg(*[F.sum(k).alias(k) for k in bits])
    return themes.select("theme").join(found, "theme", "left").na.fill(0).orderBy(F.desc("fy2023"), "theme")


def first_movers(facts: DataFrame, pattern: str = "uninsured|deposit concentration") -> DataFrame:
    """In which year companies first disclose a theme, with a running total."""
    first = facts.where(F.lower("heading").rlike(pattern)).groupBy("cik", "ticker").agg(F.min("fiscal_year").alias("first_year"))
    by_year = first.groupBy("first_year").agg(F.count("*").alias("starting"), F.array_join(F.sort_array(F.collect_list("ticker")), ", ").alias("which"))
    return by_year.select("first_year", "starting", F.sum("starting").over(Window.orderBy("first_year")).alias("cumulative"), "which").orderBy("first_year")


def churn_by_company(facts: DataFrame, more_than: int = 10, top: int = 20) -> DataFrame:
    is_label = lambda *x: F.sum(F.when(F.col("yoy_label").isin(*x), 1).otherwise(0))
    out = facts.where("yoy_label is not null").groupBy("ticker", "fiscal_year").agg(F.count("*").alias("risks"), is_label("NEW").alias("new_risks"), is_label("MATERIALLY_REVISED").alias("revised"), is_label("CARRIED_FORWARD").alias("unchanged"), percent(is_label("NEW", "MATERIALLY_REVISED"), F.count("*")).alias("pct_changed"))
    return out.where(F.col("risks") > more_than).orderBy(F.desc("pct_changed"), "ticker", "fiscal_year").limit(top)


def category_mix(facts: DataFrame) -> DataFrame:
    share = lambda c: percent(F.sum(F.when(F.col("category") == c, 1).otherwise(0)), F.count("*")).alias(c)
    return facts.where("category is not null").groupBy("fiscal_year").agg(*[share(c) for c in ("financial", "operational", "regulatory", "strategic")], F.count("*").alias("total")).orderBy("fiscal_year")


def company_vs_peers(facts: DataFrame, dim_company: DataFrame, ticker: str, year: int = 2025) -> DataFrame:
    """One company's records by category beside the share of the panel that discloses the category."""
    now = facts.where((F.col("fiscal_year") == year) & F.col("category").isNotNull())
    peers = now.groupBy("category").agg(F.countDistinct("cik").alias("peers_disclosing"))
    own = now.where(F.col("ticker") == ticker).groupBy("category").agg(F.count("*").alias("risks"))
    out = peers.join(own, "category", "left").crossJoin(_panel(dim_company))
    return out.select("category", F.coalesce("risks", F.lit(0)).alias("own_risk_factors"), "peers_disclosing", percent(F.col("peers_disclosing"), F.col("panel")).alias("pct_of_peers")).orderBy(F.desc("peers_disclosing"), "category")


def template_propagation(facts: DataFrame, least: int = 3, top: int = 15, letters: int = 90) -> DataFrame:
    """Headings that several companies use in the same words."""
    start = facts.select(F.substring("heading", 1, letters).alias("heading_start"), "cik", "ticker", "fiscal_year")
    out = start.groupBy("heading_start").agg(F.countDistinct("cik").alias("companies"), F.array_join(F.sort_array(F.collect_set("ticker")), ", ").alias("which"), F.min("fiscal_year").alias("first_seen"))
    return out.where(F.col("companies") >= least).orderBy(F.desc("companies"), "heading_start").limit(top)


def data_quality(quarantine: DataFrame, raw: DataFrame) -> DataFrame:
    total = F.broadcast(raw.agg(F.count("*").alias("raw")))
    return quarantine.groupBy("reason").agg(F.count("*").alias("records")).crossJoin(total).select("reason", "records", percent(F.col("records"), F.col("raw"), 2).alias("pct_of_raw")).orderBy(F.desc("records"), "reason")


def gold_agreement(facts: DataFrame) -> DataFrame:
    return facts.where("in_gold_set AND category IS NOT NULL").groupBy(F.col("gold_category").alias("truth"), F.col("category").alias("predicted")).agg(F.count("*").alias("n")).orderBy("truth", F.desc("n"), "predicted")


def what_disappeared(dropped: DataFrame, top: int = 25) -> DataFrame:
    return dropped.select("dropped_in_fiscal_year", "ticker", F.substring("heading", 1, 100).alias("stopped_disclosing"), "risk_id").orderBy(F.desc("dropped_in_fiscal_year"), "ticker", "risk_id").limit(top)


def matches_pattern(text: Column, pattern: str) -> Column:
    """A case-insensitive search; false for null."""
    return F.coalesce(text.rlike(f"(?iu){pattern}"), F.lit(False))


def signal_by_year(matches: DataFrame, pattern: str) -> DataFrame:
    """Matching rows by year and label, zeros included."""
    years = matches.select("fiscal_year").distinct()
    hits = matches.where(matches_pattern(F.col("heading"), pattern)).groupBy("fiscal_year").pivot("label", list(LABELS)).count()
    return years.join(hits, "fiscal_year", "left").na.fill(0)


def signal_firms(matches: DataFrame, pattern: str, label: str = "NEW") -> DataFrame:
    """Distinct companies by year with a matching row of a label, as a share of the panel with its interval."""
    panel = F.broadcast(matches.agg(F.countDistinct("cik").alias("panel")))
    hit = matches_pattern(F.col("heading"), pattern) & (F.col("label") == label)
    by_year = matches.groupBy("fiscal_year").agg(F.countDistinct(F.when(hit, F.col("ticker"))).alias("firms"))
    k, n = F.col("firms"), F.col("panel")
    return by_year.crossJoin(panel).select("fiscal_year", "firms", "panel", percent(k, n).alias("pct"), F.round(100 * wilson_low(k, n), 1).alias("low"), F.round(100 * wilson_high(k, n), 1).alias("high"))


def signal_peak(matches: DataFrame, pattern: str, label: str = "NEW") -> DataFrame:
    """The year with the most companies (the first of several) and who they are."""
    hits = matches.where(matches_pattern(F.col("heading"), pattern) & (F.col("label") == label)).groupBy("fiscal_year").agg(F.countDistinct("ticker").alias("firms"), F.array_join(F.sort_array(F.collect_set("ticker")), ", ").alias("which"))
    return hits.orderBy(F.desc("firms"), "fiscal_year").limit(1)


def signal_headings(matches: DataFrame, pattern: str, label: str, year: int) -> DataFrame:
    return matches.where(matches_pattern(F.col("heading"), pattern) & (F.col("label") == label) & (F.col("fiscal_year") == year)).select("ticker", F.substring("heading", 1, 150).alias("heading"), "review").orderBy("ticker", "heading")


def verify_new(matches: DataFrame, records: DataFrame, edges: DataFrame, pattern: str, year: int, top: int | None = 5) -> DataFrame:
    """For each new record of a theme, the same company's records of the year before by similarity; `further` counts those beyond `top` that are at 0.05 or less."""
    targets = matches.where((F.col("label") == "NEW") & (F.col("fiscal_year") == year) & matches_pattern(F.col("heading"), pattern)).select("cik", "ticker", "curr_id", F.col("heading").alias("new_heading"))
    prior = records.where(F.col("fiscal_year") == year - 1).select("cik", F.col("risk_id").alias("prev_id"), F.col("heading").alias("prior_heading"))
    sims = edges.select("curr_id", "prev_id", "sim")
    found = targets.join(prior, "cik", "left").join(sims, ["curr_id", "prev_id"], "left").withColumn("sim", F.coalesce("sim", F.lit(0.0)))
    w = Window.partitionBy("curr_id").orderBy(F.desc("sim"), F.asc_nulls_last("prior_heading"), F.asc_nulls_last("prev_id"))
    ranked = found.withColumn("rank", F.row_number().over(w))
    if top is not None:
        ranked = ranked.withColumn("further", F.count_if((F.col("rank") > top) & (F.col("sim") <= 0.05)).over(Window.partitionBy("curr_id"))).where(F.col("rank") <= top)
    return ranked.withColumn("above_minimum", F.col("sim") >= MATCH_MIN).withColumn("sim", F.round("sim", 4))


def app_extract(records: DataFrame, matches: DataFrame, categories: DataFrame, flagged: tuple[int, ...] = ()) -> DataFrame:
    """Rows for the dashboard: every record with its labels, then the records that have gone (under their earlier id, so ids repeat)."""
    m = matches.where("curr_id is not null").select(F.col("curr_id").alias("risk_id"), F.col("label").alias("yoy_label"), "similarity", "review")
    c = categories.select("risk_id", "category", F.col("classifier").alias("category_source"))
    base = records.select("risk_id", "cik", "ticker", F.col("company_name").alias("company"), "fiscal_year", F.substring("heading", 1, 240).alias("heading"), "filer_category", "chars", F.col("cik").isin(*flagged).alias("caveat") if flagged else F.lit(False).alias("caveat"))
    empty = lambda *names: {n: F.lit("") for n in names}
    now = base.join(m, "risk_id", "left").join(c, "risk_id", "left").na.fill("", ["yoy_label", "review", "category", "category_source"])
    gone = matches.where("label = 'DROPPED'").select(F.col("prev_id").alias("risk_id"), F.col("fiscal_year").alias("gone_in"), F.col("label").alias("yoy_label"), "similarity", "review")
    gone = base.join(gone, "risk_id").withColumn("fiscal_year", F.col("gone_in")).drop("gone_in").withColumns({"chars": F.lit(0).cast("long")} | empty("company", "filer_category", "category", "category_source"))
    return now.unionByName(gone.select(now.columns))


def coverage(extract: DataFrame) -> DataFrame:
    """One row of figures for the dashboard's tiles."""
    return extract.agg(F.countDistinct("ticker").alias("companies"), F.countDistinct("fiscal_year").alias("fiscal_years"), F.count("*").alias("risk_factors"), F.count_if(F.col("category_source") == "llm").alias("llm_coverage"), F.count_if(F.col("category_source") == "keywords").alias("baseline_coverage"), F.count_if("caveat").alias("with_caveat"))


#: Marks of the labels on the dashboard.
MARKS = {"NEW": "🟢", "DROPPED": "🔴", "MATERIALLY_REVISED": "🟡", "CARRIED_FORWARD": "⚪", "AMBIGUOUS": "⚫"}


def marked(rows: DataFrame) -> DataFrame:
    """`mark`: a sign for each label, empty where there is none."""
    signs = F.create_map(*[F.lit(x) for pair in MARKS.items() for x in pair])
    return rows.withColumn("mark", F.coalesce(F.element_at(signs, F.col("yoy_label")), F.lit("")))


def theme_share_by_year(extract: DataFrame, themes: dict[str, str] = SIGNALS) -> DataFrame:
    """Percent of the panel with a new record of each theme, for all years but the first; 0 where there is none."""
    panel = F.broadcast(extract.agg(F.countDistinct("cik").alias("panel"), F.min("fiscal_year").alias("first")))
    years = extract.select("fiscal_year").distinct().crossJoin(panel).where("fiscal_year > first")
    new = extract.where("yoy_label = 'NEW'")
    each = [new.where(matches_pattern(F.col("heading"), p)).groupBy("fiscal_year").agg(F.countDistinct("cik").alias("n")).withColumn("theme", F.lit(t)) for t, p in themes.items()]
    found = each[0]
    for e in each[1:]:
        found = found.unionByName(e)
    grid = years.crossJoin(F.broadcast(extract.sparkSession.createDataFrame([(t,) for t in themes], "theme string")))
    return grid.join(found, ["fiscal_year", "theme"], "left").select("fiscal_year", "theme", percent(F.coalesce("n", F.lit(0)), F.col("panel")).alias("pct"))


def company_labels(extract: DataFrame, ticker: str) -> DataFrame:
    rows = extract.where((F.col("ticker") == ticker) & (F.col("yoy_label") != ""))
    return rows.groupBy("fiscal_year").pivot("yoy_label", list(LABELS)).count().na.fill(0).join(extract.where(F.col("ticker") == ticker).groupBy("fiscal_year").agg(F.bool_or("caveat").alias("caveat")), "fiscal_year")


def search(extract: DataFrame, pattern: str | None = None, labels: list[str] | None = None, categories: list[str] | None = None, first: int | None = 400) -> DataFrame:
    rows = extract
    if pattern:
        rows = rows.where(matches_pattern(F.col("heading"), pattern))
    if labels:
        rows = rows.where(F.col("yoy_label").isin(*labels))
    if categories:
        rows = rows.where(F.col("category").isin(*categories))
    return rows if first is None else rows.orderBy("fiscal_year", "ticker", "risk_id", "yoy_label").limit(first)


def new_by_year(rows: DataFrame) -> DataFrame:
    return rows.where("yoy_label = 'NEW'").groupBy("fiscal_year").agg(F.countDistinct("cik").alias("companies")).orderBy("fiscal_year")
