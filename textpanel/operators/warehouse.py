"""The warehouse: raw rows, quarantine with reasons, clean rows, dimensions and facts, and checks on all of it."""

from __future__ import annotations

import uuid

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textpanel.constants import CATEGORY_TEXT, EXCLUDED_CIKS, FLAGGED_CIKS, MIN_BODY, MIN_HEADING
from textpanel.sources.readers import listed


def _rule(rows: DataFrame, table: str, record: Column, reason: str, detail: Column) -> DataFrame:
    return rows.select(F.lit(table).alias("source_table"), record.alias("record_id"), F.lit(reason).alias("reason"), detail.alias("detail"))


def duplicates(raw: DataFrame) -> DataFrame:
    """Records whose heading an earlier record of the same filing has."""
    nth = F.row_number().over(Window.partitionBy("cik", "fiscal_year", "heading").orderBy("risk_index"))
    return raw.select("risk_id", nth.alias("nth")).where("nth > 1")


def record_quarantine(raw: DataFrame, excluded: tuple[int, ...] = EXCLUDED_CIKS) -> DataFrame:
    """(source_table, record_id, reason, detail). The rules are independent: a record may fail several."""
    t, rid = "raw_risk_factor", F.col("risk_id")
    rules = [
        _rule(raw.where(listed(F.col("cik"), excluded)), t, rid, "excluded_company", F.concat("ticker", F.lit(" is excluded from the panel"))),
        _rule(raw.where(F.col("heading").isNull() | (F.length(F.trim("heading")) < MIN_HEADING)), t, rid, "empty_heading", F.lit("heading is blank or shorter than 10 characters")),
        _rule(raw.where(F.length("body") < MIN_BODY), t, rid, "short_body", F.lit("body is shorter than 200 characters")),
        _rule(duplicates(raw), t, rid, "duplicate_heading_in_filing", F.lit("the filing has an earlier record with this heading")),
    ]
    return reduce(lambda a, b: a.unionByName(b), rules)


def clean_records(raw: DataFrame, quarantine: DataFrame, flagged: tuple[int, ...] = FLAGGED_CIKS) -> DataFrame:
    kept = raw.join(quarantine.select(F.col("record_id").alias("risk_id")).where("risk_id is not null").distinct(), "risk_id", "left_anti")
    return kept.withColumns({"fiscal_year": F.expr("try_cast(fiscal_year AS int)"), "filer_category": F.nullif(F.trim("filer_category"), F.lit("")), "heading": F.trim("heading"), "company_has_caveat": listed(F.col("cik"), flagged)})


def match_quarantine(matches: DataFrame, clean: DataFrame) -> DataFrame:
    """Matches whose earlier record didn't become clean."""
    prev = F.nullif(F.col("prev_id"), F.lit(""))
    lost = matches.where(prev.isNotNull()).join(clean.select(F.col("risk_id").alias("prev_id")), "prev_id", "left_anti")
    return _rule(lost, "raw_yoy_match", F.col("curr_id"), "prior_risk_quarantined", F.concat(F.lit("matched with "), F.col("prev_id"), F.lit(", which is quarantined")))


def clean_matches(matches: DataFrame, clean: DataFrame) -> DataFrame:
    """Typed matches. A pointer to an earlier record that isn't clean is cleared and said to be missing; the review flag is true or null."""
    typed = matches.select(
        F.nullif(F.col("curr_id"), F.lit("")).alias("risk_id"),
        F.nullif(F.col("prev_id"), F.lit("")).alias("prior"),
        F.expr("try_cast(cik AS int)").alias("cik"),
        "ticker",
        F.expr("try_cast(fiscal_year AS int)").alias("fiscal_year"),
        F.expr("try_cast(similarity AS double)").alias("similarity"),
        F.col("label").alias("yoy_label"),
        (F.nullif(F.col("review"), F.lit("")) == "y").alias("flagged_for_review"),
    )
    known = clean.select(F.col("risk_id").alias("prior"), F.lit(True).alias("known"))
    both = typed.join(known, "prior", "left")
    return both.select("risk_id", F.when(F.col("known"), F.col("prior")).alias("prior_risk_id"), "cik", "ticker", "fiscal_year", "similarity", "yoy_label", "flagged_for_review", (F.col("prior").isNotNull() & F.col("known").isNull()).alias("prior_risk_missing"))


def clean_categories(baseline: DataFrame, model: DataFrame) -> DataFrame:
    """The model's category where it gave one, else the keywords'."""
    m = model.select("risk_id", F.nullif(F.col("category"), F.lit("")).alias("by_model"))
    both = baseline.select("risk_id", F.col("category").alias("by_words")).join(m, "risk_id", "full_outer")
    return both.select("risk_id", F.coalesce("by_model", "by_words").alias("category"), F.when(F.col("by_model").isNotNull(), "llm").otherwise("keywords").alias("classifier"))


def dim_company(clean: DataFrame) -> DataFrame:
    return clean.select("cik", "ticker", "company_name", "company_has_caveat").distinct()


def dim_fiscal_year(clean: DataFrame, event_year: int = 2023) -> DataFrame:
    return clean.select("fiscal_year").distinct().select("fiscal_year", (F.col("fiscal_year") >= event_year).alias("post_event"), F.concat(F.col("fiscal_year").cast("string"), F.lit("-12-31")).alias("period_end"))


def dim_category(categories: DataFrame) -> DataFrame:
    text = F.lit(None).cast("string")
    for c, t in CATEGORY_TEXT.items():
        text = F.when(F.col("category") == c, t).otherwise(text)
    return categories.where("category is not null").select("category").distinct().withColumn("description", text)


def described(clean: DataFrame, categories: DataFrame, gold: DataFrame) -> DataFrame:
    """Clean records with categories, but without what matching says of them."""
    c = categories.select("risk_id", "category", F.col("classifier").alias("category_classifier"))
    g = gold.select("risk_id", F.col("category").alias("gold_category"))
    return clean.drop("body").join(c, "risk_id", "left").join(g, "risk_id", "left").withColumn("in_gold_set", F.col("gold_category").isNotNull())


def fact(clean: DataFrame, categories: DataFrame, matches: DataFrame, gold: DataFrame) -> DataFrame:
    m = matches.where("risk_id is not null").select("risk_id", "yoy_label", "similarity", "prior_risk_id", "flagged_for_review", "prior_risk_missing")
    return described(clean, categories, gold).join(m, "risk_id", "left").withColumn("prior_risk_missing", F.coalesce("prior_risk_missing", F.lit(False)))


def dropped(matches: DataFrame, clean: DataFrame) -> DataFrame:
    """Records that weren't continued, with the year from which they are gone."""
    m = matches.where("yoy_label = 'DROPPED'").select(F.col("prior_risk_id").alias("risk_id"), "cik", "ticker", F.col("fiscal_year").alias("dropped_in_fiscal_year"))
    return m.join(clean.select("risk_id", "heading", F.col("fiscal_year").alias("last_disclosed_fiscal_year")), "risk_id")


def quality_scalars(facts: DataFrame, quarantine: DataFrame) -> DataFrame:
    q = quarantine.agg(F.count("*").alias("quarantined"))
    return facts.agg(
        F.countDistinct("cik").alias("companies"),
        F.countDistinct("fiscal_year").alias("fiscal_years"),
        F.count("*").alias("risk_factors"),
        F.count_if(F.col("category").isNull()).alias("missing_category"),
        F.count_if(F.col("yoy_label").isNull()).alias("missing_yoy_label"),
        F.count_if(F.col("flagged_for_review")).alias("flagged_for_review"),
        F.count_if(F.col("company_has_caveat")).alias("from_caveat_companies"),
        F.count_if(F.col("in_gold_set")).alias("in_gold_set"),
    ).crossJoin(q)


def completeness(facts: DataFrame) -> DataFrame:
    return facts.groupBy("fiscal_year").agg(F.count("*").alias("risks"), F.count("category").alias("categorised"), F.count("yoy_label").alias("matched"))


def classifier_coverage(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.coalesce("category_classifier", F.lit("(none)")).alias("classifier")).agg(F.count("*").alias("n"))


def integrity(facts: DataFrame, clean: DataFrame, excluded: tuple[int, ...] = EXCLUDED_CIKS) -> DataFrame:
    """(check, n): all but the known second one must be 0."""
    orphans = facts.where("prior_risk_id is not null").join(clean.select(F.col("risk_id").alias("prior_risk_id")), "prior_risk_id", "left_anti")
    twice = facts.groupBy("risk_id").count().where("count > 1")
    checks = {
        "orphan prior_risk_id": orphans,
        "match with a quarantined prior risk": facts.where("prior_risk_missing"),
        "duplicate risk_id": twice,
        "excluded company leaked in": facts.where(listed(F.col("cik"), excluded)),
        "NEW with a prior risk attached": facts.where("yoy_label = 'NEW' AND prior_risk_id IS NOT NULL"),
    }
    return reduce(lambda a, b: a.unionByName(b), [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("check"), "n") for k, df in checks.items()])


def build(raw: DataFrame, matches: DataFrame, baseline: DataFrame, model: DataFrame, gold: DataFrame, excluded: tuple[int, ...] = EXCLUDED_CIKS, flagged: tuple[int, ...] = FLAGGED_CIKS) -> dict[str, DataFrame]:
    """All layers by name. Optional inputs may be empty frames, but must have their columns."""
    first = record_quarantine(raw, excluded)
    clean = clean_records(raw, first, flagged)
    quarantine = first.unionByName(match_quarantine(matches, clean))
    matched, categories = clean_matches(matches, clean), clean_categories(baseline, model)
    return {
        "quarantine": quarantine,
        "clean_risk_factor": clean,
        "clean_yoy_match": matched,
        "clean_category": categories,
        "dim_company": dim_company(clean),
        "dim_fiscal_year": dim_fiscal_year(clean),
        "dim_category": dim_category(categories),
        "mart_risk_factor": fact(clean, categories, matched, gold),
        "mart_dropped_risk": dropped(matched, clean),
    }


#: What a parsed query may consist of; everything else (commands, inserts and whatever else changes something) is refused.
QUERY_NODES = frozenset(
    "Project Filter Aggregate Join LateralJoin Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect Generate Pivot Unpivot Sample SubqueryAlias OneRowRelation OneRowRelation$ LocalRelation UnresolvedHint RepartitionByExpression "
    "UnresolvedRelation UnresolvedWith UnresolvedHaving UnresolvedInlineTable UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction UnresolvedGenerate WithWindowDefinition Window Tail".split()
)


#: Functions that run whatever a question names.
REACHING_OUT = frozenset(("java_method", "reflect", "try_reflect"))


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def only_reads(spark: SparkSession, sql: str) -> bool:
    """Whether the parsed statement is a query through and through, its common table expressions too, and calls nothing outside of SQL."""
    todo = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() not in QUERY_NODES:
            return False
        todo += _each(node.children()) + _each(node.innerChildren())
        said = _each(node.expressions())
        while said:
            e = said.pop()
            if e.getClass().getSimpleName() == "UnresolvedFunction" and e.nameParts().last().lower() in REACHING_OUT:
                return False
            said += _each(e.children())
    return True


def ask(layers: dict[str, DataFrame], sql: str) -> DataFrame:
    """A question in SQL over the layers by name; nothing in them is changed, and their names are known to it alone: they hide the caller's views, which stay."""
    spark = next(iter(layers.values())).sparkSession
    sql = sql.strip().rstrip(";")
    if not only_reads(spark, sql):
        raise ValueError("only queries are allowed")
    own = {name: f"layer_{uuid.uuid4().hex}" for name in layers}
    for name, df in layers.items():
        df.createOrReplaceTempView(own[name])
    try:
        return spark.sql("WITH " + ", ".join(f"`{k}` AS (SELECT * FROM {v})" for k, v in own.items()) + f" ({sql}\n)")
    finally:
        for name in own.values():
            spark.catalog.dropTempView(name)
