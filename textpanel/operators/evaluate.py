"""Scores of a classifier against labels: confusion, precision, recall, F1, floors, comparisons, agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpanel.functions.stats import ratio, wilson_high, wilson_low


def joined(gold: DataFrame, pred: DataFrame, key: str = "risk_id") -> DataFrame:
    """(key, truth, predicted) of items that both have."""
    return gold.select(key, F.col("category").alias("truth")).join(pred.select(key, F.col("category").alias("predicted")), key)


def confusion(both: DataFrame) -> DataFrame:
    """(truth, predicted, n) for every pair of classes, zeros included."""
    classes = both.select(F.explode(F.array("truth", "predicted")).alias("c")).distinct()
    grid = classes.select(F.col("c").alias("truth")).crossJoin(classes.select(F.col("c").alias("predicted")))
    return grid.join(both.groupBy("truth", "predicted").agg(F.count("*").alias("n")), ["truth", "predicted"], "left").na.fill(0, ["n"])


def per_class(both: DataFrame) -> DataFrame:
    """(class, tp, fp, fn, precision, recall, f1, support); a ratio without a denominator is 0."""
    hit = F.col("truth") == F.col("predicted")
    sides = both.select(F.explode(F.array(F.struct(F.col("truth").alias("class"), F.lit("t").alias("side")), F.struct(F.col("predicted").alias("class"), F.lit("p").alias("side")))).alias("x"), hit.alias("hit")).select("x.*", "hit")
    counts = sides.groupBy("class").agg(F.count_if((F.col("side") == "t") & F.col("hit")).alias("tp"), F.count_if((F.col("side") == "p") & ~F.col("hit")).alias("fp"), F.count_if((F.col("side") == "t") & ~F.col("hit")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = counts.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "support": tp + fn})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def summary(both: DataFrame) -> DataFrame:
    """n, accuracy with its interval, macro F1 and the floor of always naming the largest class."""
    hits = both.agg(F.count("*").alias("n"), F.count_if(F.col("truth") == F.col("predicted")).alias("hits"))
    floor = both.groupBy("truth").count().agg(F.max("count").alias("largest"))
    macro = per_class(both).agg(F.avg("f1").alias("macro_f1"))
    n, k = F.col("n"), F.col("hits")
    return hits.crossJoin(floor).crossJoin(macro).select("n", ratio(k, n).alias("accuracy"), wilson_low(k, n).alias("low"), wilson_high(k, n).alias("high"), F.coalesce("macro_f1", F.lit(0.0)).alias("macro_f1"), ratio(F.coalesce("largest", F.lit(0)), n).alias("majority_floor"))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """F1 of two systems by class, a class that one lacks counting 0 there; `b_wins` marks classes where the second is better."""
    fa, fb = per_class(a).select("class", F.col("f1").alias("f1_a")), per_class(b).select("class", F.col("f1").alias("f1_b"))
    both = fa.join(fb, "class", "full_outer").na.fill(0.0)
    return both.select("class", "f1_a", "f1_b", (100 * (F.col("f1_a") - F.col("f1_b"))).alias("lift"), (F.col("f1_b") > F.col("f1_a")).alias("b_wins"))


def lift(a: DataFrame, b: DataFrame) -> DataFrame:
    """Accuracy and macro F1 of two systems and the difference in points; under 5 points of accuracy no winner should be named."""
    sa, sb = summary(a).select(F.col("accuracy").alias("accuracy_a"), F.col("macro_f1").alias("macro_a")), summary(b).select(F.col("accuracy").alias("accuracy_b"), F.col("macro_f1").alias("macro_b"))
    d = 100 * (F.col("accuracy_a") - F.col("accuracy_b"))
    return sa.crossJoin(sb).withColumns({"lift_accuracy": d, "lift_macro": 100 * (F.col("macro_a") - F.col("macro_b")), "within_noise": F.abs(d) < 5})


def agreement(first: DataFrame, second: DataFrame, column: str = "category", key: str = "risk_id") -> DataFrame:
    """How often two passes over the same items agree."""
    both = first.select(key, F.col(column).alias("a")).join(second.select(key, F.col(column).alias("b")), key).where("coalesce(a, '') <> '' AND coalesce(b, '') <> ''")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("agree")).withColumn("rate", ratio(F.col("agree"), F.col("n")))


def disagreements(first: DataFrame, second: DataFrame, column: str = "category", key: str = "risk_id", top: int = 10) -> DataFrame:
    both = first.select(key, F.col(column).alias("a")).join(second.select(key, F.col(column).alias("b")), key).where("a <> b")
    return both.groupBy("a", "b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "a", "b").limit(top)


def status(gold: DataFrame, allowed: dict[str, tuple[str, ...]]) -> DataFrame:
    """(field, value, n, valid) of a worksheet's label columns."""
    out = None
    for field, values in allowed.items():
        one = gold.groupBy(F.coalesce(F.trim(field), F.lit("")).alias("value")).agg(F.count("*").alias("n")).select(F.lit(field).alias("field"), "value", "n", (F.col("value").isin(*values) | (F.col("value") == "")).alias("valid"))
        out = one if out is None else out.unionByName(one)
    return out


def audit_score(audit: DataFrame, correct: tuple[str, ...] = ("C",), unsure: str = "?") -> DataFrame:
    """Accuracy of a split audit with its interval; rows without a verdict are left out, unsure ones counted apart."""
    label = F.coalesce(F.trim("label"), F.lit(""))
    k, n = F.col("correct"), F.col("n")
    counts = audit.agg(F.count_if(label.isin("C", "F", "T", "M")).alias("n"), F.count_if(label.isin(*correct)).alias("correct"), F.count_if(label == unsure).alias("unsure"))
    return counts.select("n", "correct", "unsure", ratio(k, n).alias("accuracy"), wilson_low(k, n).alias("low"), wilson_high(k, n).alias("high"))


def audit_errors(audit: DataFrame) -> DataFrame:
    return audit.where(F.trim("label").isin("F", "T", "M")).groupBy("ticker", F.trim("label").alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker", "label")


def neighbours(records: DataFrame, targets: DataFrame) -> DataFrame:
    """The records before, at and after each target in its filing, with the distance, and a verdict on the filing's record count."""
    i = F.col("risk_index")
    t = targets.select("cik", "fiscal_year", i.alias("target_index"), F.explode(F.array(i - 1, i, i + 1)).alias("risk_index"))
    sizes = records.groupBy("cik", "fiscal_year").agg(F.count("*").alias("n_records"))
    verdict = F.when(F.col("n_records") < 15, "few").when(F.col("n_records") <= 70, "usual").otherwise("many")
    near = records.join(t, ["cik", "fiscal_year", "risk_index"]).join(sizes, ["cik", "fiscal_year"])
    return near.select("cik", "fiscal_year", "target_index", (F.col("risk_index") - F.col("target_index")).alias("distance"), "risk_id", "heading", "n_records", verdict.alias("verdict"))
