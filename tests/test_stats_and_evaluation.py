import pytest
from pyspark.sql import functions as F

from textpanel.functions.stats import wilson_high, wilson_low
from textpanel.operators import evaluate, sampling
from textpanel.sources.sinks import refuse_if_labelled

CLASSES = ("financial", "operational", "regulatory", "strategic")
#: Published confusion matrices of two classifiers, rows are truths.
WORDS = ((107, 0, 5, 6), (11, 42, 2, 6), (7, 0, 58, 3), (5, 2, 5, 41))
MODEL = ((112, 2, 2, 2), (3, 57, 0, 1), (0, 0, 67, 1), (2, 3, 3, 45))


def rows(spark, matrix):
    cells = [(f"{t}{p}{k}{i}", CLASSES[t], CLASSES[p]) for t, r in enumerate(matrix) for p, n in enumerate(r) for k, i in [(0, i) for i in range(n)]]
    return spark.createDataFrame(cells, "risk_id string, truth string, predicted string")


@pytest.mark.parametrize(("matrix", "accuracy", "macro", "low", "high"), [(WORDS, 0.827, 0.814, 0.780, 0.865), (MODEL, 0.937, 0.930, 0.903, 0.959)])
def test_summary_matches_published_scores(spark, matrix, accuracy, macro, low, high):
    s = evaluate.summary(rows(spark, matrix)).first()
    assert s.n == 300
    assert (round(s.accuracy, 3), round(s.macro_f1, 3), round(s.low, 3), round(s.high, 3)) == (accuracy, macro, low, high)
    assert round(s.majority_floor, 3) == 0.393


def test_per_class_and_confusion(spark):
    got = {r["class"]: r for r in evaluate.per_class(rows(spark, WORDS)).collect()}
    assert [round(got[c].f1, 3) for c in CLASSES] == [0.863, 0.800, 0.841, 0.752]
    assert [got[c].support for c in CLASSES] == [118, 61, 68, 53]
    cells = {(r.truth, r.predicted): r.n for r in evaluate.confusion(rows(spark, WORDS)).collect()}
    assert len(cells) == 16 and cells["financial", "operational"] == 0 and cells["operational", "financial"] == 11


def test_compare_names_no_winner_by_noise(spark):
    a, b = rows(spark, MODEL), rows(spark, WORDS)
    got = evaluate.lift(a, b).first()
    assert round(got.lift_accuracy, 1) == 11.0 and not got.within_noise
    assert not any(r.b_wins for r in evaluate.compare(a, b).collect())


@pytest.mark.parametrize(("k", "n", "low", "high"), [(8, 50, 8.3, 28.5), (13, 50, 15.9, 39.6), (17, 50, 22.4, 47.8), (21, 48, 30.7, 57.7), (4, 48, 3.3, 19.6), (0, 0, 0.0, 0.0), (0, 5, 0.0, 43.4), (5, 5, 56.6, 100.0)])
def test_wilson(spark, k, n, low, high):
    r = spark.createDataFrame([(k, n)], "k int, n int").select(wilson_low(F.col("k"), F.col("n")).alias("a"), wilson_high(F.col("k"), F.col("n")).alias("b")).first()
    assert (round(100 * r.a, 1), round(100 * r.b, 1)) == (low, high)


def test_empty_evaluation(spark):
    s = evaluate.summary(rows(spark, ((0,),))).first()
    assert s.n == 0 and s.accuracy == 0 and s.macro_f1 == 0


def test_agreement_and_status(spark):
    a = spark.createDataFrame([("1", "financial"), ("2", "strategic"), ("3", "")], "risk_id string, category string")
    b = spark.createDataFrame([("1", "financial"), ("2", "financial"), ("3", "strategic")], "risk_id string, category string")
    got = evaluate.agreement(a, b).first()
    assert (got.n, got.agree, got.rate) == (2, 1, 0.5)
    assert evaluate.disagreements(a.where("category <> ''"), b).collect()[0].asDict() == {"a": "strategic", "b": "financial", "n": 1}
    status = {(r.value, r.valid) for r in evaluate.status(a.withColumn("category", F.when(F.col("risk_id") == "2", "odd").otherwise(F.col("category"))), {"category": CLASSES}).collect()}
    assert status == {("financial", True), ("", True), ("odd", False)}


def test_stratified_sample_takes_turns(spark):
    df = spark.createDataFrame([(f"r{i}", i % 3 if i < 60 else 3) for i in range(100)], "risk_id string, cell int")
    got = sampling.stratified(df, ["cell"], 10).groupBy("cell").count().collect()
    assert sorted(r["count"] for r in got) == [2, 2, 3, 3]
    again = [r.risk_id for r in sampling.stratified(df.repartition(7), ["cell"], 10).collect()]
    assert sorted(again) == sorted(r.risk_id for r in sampling.stratified(df, ["cell"], 10).collect())


def test_relabelling_is_blank_and_labels_are_guarded(spark):
    gold = spark.createDataFrame([("1", "financial", "y"), ("2", "strategic", "n"), ("3", "", "")], "risk_id string, category string, split_ok string")
    sheet = sampling.blank_for_relabelling(gold, ["category", "split_ok"], 5)
    assert sheet.count() == 2 and {(r.category, r.split_ok) for r in sheet.collect()} == {("", "")}
    with pytest.raises(ValueError, match="refusing"):
        refuse_if_labelled(gold, ("category",))
    refuse_if_labelled(sheet, ("category", "split_ok"))
