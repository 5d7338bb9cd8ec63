import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textpanel.functions import text
from textpanel.operators import analysis, evaluate, splitting
from textpanel.sources import readers, sinks


def test_frame_of_reported_values(spark):
    frame = spark.createDataFrame([([(1, "A old", 30), (1, "A", 50), (2, "B", 999), (3, "C", None)],)], "data array<struct<cik:long,entityName:string,val:long>>")
    assert {tuple(r) for r in readers.frame_values(frame, 10, 500).collect()} == {(1, "A", 50)}


def test_submissions_and_their_overflow(spark, tmp_path):
    arrays = lambda *rows: {c: [r[i] for r in rows] for i, c in enumerate(readers.HISTORY_FIELDS)}
    row = lambda form, n: [form if c == "form" else f"{c}{n}" for c in readers.HISTORY_FIELDS]
    kinds = ", ".join(f"{c}:array<string>" for c in readers.HISTORY_FIELDS)
    (tmp_path / "s.json").write_text(json.dumps({"cik": "7", "filings": {"recent": arrays(row("10-K", 1), row("8-K", 2))}}))
    (tmp_path / "o.json").write_text(json.dumps({"cik": "7"} | arrays(row("10-K", 3))))
    recent = spark.read.schema(f"cik string, filings struct<recent:struct<{kinds}>>").json(str(tmp_path / "s.json"))
    older = spark.read.schema("cik string, " + kinds.replace(":", " ")).json(str(tmp_path / "o.json"))
    got = readers.filing_history(recent, older).collect()
    assert sorted(r.form for r in got) == ["10-K", "10-K", "8-K"] and {r.cik for r in got} == {"7"}
    assert {r["accessionNumber"] for r in got} == {f"accessionNumber{n}" for n in (1, 2, 3)} and readers.filing_history(recent).count() == 2


def test_numbers_relations_and_versions(spark, tmp_path):
    df = readers.numbers_or_null(spark.createDataFrame([("12", "x"), ("1.5", ""), (None, "3")], "a string, b string"), "a", "b")
    assert [tuple(r) for r in df.collect()] == [(12, None), (None, None), (None, 3)]
    readers.relation(spark, "small_relation", [(1, "a")], "id int, name string")
    assert spark.sql("SELECT name FROM small_relation WHERE id = 1").first()[0] == "a"
    (tmp_path / "prompt_v2.txt").write_text("Name the\ncategory.")
    assert readers.text_version(spark, str(tmp_path), "prompt", "v2") == "Name the\ncategory."


def test_union_of_columns_and_nested_documents(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "cik int, note string"), spark.createDataFrame([(2, 2022)], "cik int, fiscal_year int")
    both = sinks.union_of_columns(a, b)
    assert both.columns == ["cik", "note", "fiscal_year"] and {tuple(r) for r in both.collect()} == {(1, "x", None), (2, None, 2022)}
    sinks.nested_documents(spark.createDataFrame([(1, 2021, "a"), (1, 2022, "b")], "cik int, fiscal_year int, heading string"), str(tmp_path / "n"))
    files = [p for p in Path(tmp_path, "n").rglob("*.json")]
    assert {p.parent.name for p in files} == {"fiscal_year=2021", "fiscal_year=2022"} and {p.parent.parent.name for p in files} == {"cik=1"}
    assert {(r.fiscal_year, r.heading) for r in spark.read.json(str(tmp_path / "n")).collect()} == {(2021, "a"), (2022, "b")}


def test_logs_are_appended_to_and_metrics_written(spark, tmp_path):
    for i in range(2):
        sinks.append_log(spark.createDataFrame([(i,)], "id int"), str(tmp_path / "log"))
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "log")).collect()) == [0, 1]
    assert json.loads(sinks.metrics_json(spark.createDataFrame([(3, 0.5)], "n int, share double"))) == {"n": 3, "share": 0.5}


def test_layer_tables_are_replaced(spark):
    for n in (1, 2):
        sinks.layer_table(spark.range(n).toDF("id"), "some_layer")
        assert spark.table("some_layer").count() == n
    spark.sql("DROP TABLE some_layer")


def test_audits_count_unsure_verdicts_apart(spark):
    audit = spark.createDataFrame([("C", "A"), (" C ", "A"), ("F", "B"), ("?", "B"), ("", "B"), (None, "B"), ("T", "A")], "label string, ticker string")
    r = evaluate.audit_score(audit).first()
    assert (r.n, r.correct, r.unsure, r.accuracy) == (4, 2, 1, 0.5) and r.low < 0.5 < r.high
    assert {tuple(x) for x in evaluate.audit_errors(audit).collect()} == {("B", "F", 1), ("A", "T", 1)}


def test_headings_behind_a_theme(spark):
    rows = [("A", 2023, "NEW", "Deposit outflow risk", "y"), ("B", 2023, "NEW", "Other", ""), ("C", 2022, "NEW", "Deposit outflow", ""), ("D", 2023, "DROPPED", "deposit outflow", "")]
    df = spark.createDataFrame(rows, "ticker string, fiscal_year int, label string, heading string, review string")
    assert [tuple(r) for r in analysis.signal_headings(df, "deposit", "NEW", 2023).collect()] == [("A", "Deposit outflow risk", "y")]


def test_extremes_of_a_report(spark):
    df = spark.createDataFrame([(i, (i * 7) % 5) for i in range(9)], "id int, n int")
    got = splitting.extremes(df, {"fewest": F.col("n"), "most": F.desc("n")}, "id", n=2).collect()
    assert {tuple(r) for r in got} == {("fewest", 1, 0), ("fewest", 2, 5), ("most", 1, 2), ("most", 2, 7)}


def test_urls_and_white_space(spark):
    df = spark.createDataFrame([("0000012", "0001-23-45", "d.htm", "a   \n b")], "cik string, accession string, document string, t string")
    r = df.select(text.archive_url("https://x.org/data", F.col("cik"), F.col("accession"), F.col("document")).alias("u"), text.squash(F.col("t")).alias("s")).first()
    assert (r.u, r.s) == ("https://x.org/data/12/00012345/d.htm", "a b")


@pytest.mark.parametrize(("day", "year"), [("2022-06-30", 2021), ("2022-07-01", 2022), ("", None), (None, None), ("soon", None)])
def test_fiscal_years_of_anything(spark, day, year):
    assert spark.createDataFrame([(day,)], "d string").select(text.fiscal_year(F.col("d"))).first()[0] == year


def test_damaged_archives_keep_their_row(spark, tmp_path):
    import gzip

    (tmp_path / "good.gz").write_bytes(gzip.compress(b"<p>x</p>"))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"<p>y</p>" * 90)[:-20])
    (tmp_path / "odd.gz").write_bytes(b"\x1f\x8b\x08 nonsense")
    got = {r.path.rsplit("/", 1)[1]: (r.html, r.ok, r.reason) for r in readers.compressed_documents(spark, str(tmp_path)).collect()}
    assert got == {"good.gz": ("<p>x</p>", True, None), "cut.gz": (None, False, "damaged_archive"), "odd.gz": (None, False, "damaged_archive")}


def test_resuming_by_filter_is_the_plain_anti_join(spark, tmp_path, monkeypatch):
    import random

    monkeypatch.setattr(sinks, "BATCHES", 2)
    luck, path, have = random.Random(6), str(tmp_path / "log"), set()
    for _ in range(4):
        keys = [luck.choice([None, *map(str, range(60))]) for _ in range(25)]
        n = sinks.append_resumable(spark.createDataFrame([(k, "x") for k in keys], "risk_id string, heading string"), path, "risk_id")
        new = {k for k in keys if k is not None} - have
        assert n == len(new) + (None in keys)
        have |= new
    got = [r.risk_id for r in spark.read.parquet(path).collect() if r.risk_id is not None]
    assert sorted(got) == sorted(have)


def test_filter_lets_few_new_keys_through_and_no_old_one(spark):
    old, new = spark.range(5000).selectExpr("cast(id as string) as k"), spark.range(5000, 10_000).selectExpr("cast(id as string) as k")
    filters = sinks.seen_bits(old, "k").cache()
    assert sinks.maybe_seen(old, filters, "k").count() == 5000
    assert sinks.maybe_seen(new, filters, "k").count() < 5000 / 20
    assert sinks.maybe_seen(new, filters.limit(0), "k").count() == 0


def test_a_log_from_before_gets_a_filter(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("1",), ("2",)], "risk_id string").write.parquet(path)
    assert [sinks.append_resumable(spark.createDataFrame([(k,) for k in ("1", "3")], "risk_id string"), path, "risk_id") for _ in range(2)] == [1, 0]
    assert sorted(r.risk_id for r in spark.read.parquet(path).collect()) == ["1", "2", "3"] and spark.read.parquet(f"{path}-seen").count() == 2
