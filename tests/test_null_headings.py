from textpanel.operators import analysis


def test_prior_records_without_a_heading_come_last(spark):
    """in SQL, a null heading stands behind all others; among records at 0, only headings and ids decide."""
    labels = spark.createDataFrame([(1, "src1", 2023, "now", "the end", "NEW")], "cik int, ticker string, fiscal_year int, curr_id string, heading string, label string")
    records = spark.createDataFrame([("a", 1, 2022, None), ("b", 1, 2022, "z"), ("c", 1, 2022, "")], "risk_id string, cik int, fiscal_year int, heading string")
    edges = spark.createDataFrame([], "curr_id string, prev_id string, sim double")
    got = analysis.verify_new(labels, records, edges, "the", 2023).orderBy("rank").collect()
    assert [x.prev_id for x in got] == ["c", "b", "a"]
