import gzip
import json

import pytest
from pyspark.sql import functions as F

from textpanel.constants import KEYWORDS
from textpanel.functions import text
from textpanel.operators import external, faults, keywords, universe, warehouse
from textpanel.plans import records as r
from textpanel.plans import registry
from textpanel.sources import fetch, readers, sinks
from textpanel.streaming.ingest import follow

SF = "/root/testdata/sf0.001"


def test_keyword_terms_and_ties(spark):
    df = spark.createDataFrame([("1", "", "nothing of note"), ("2", "Cyber attacks", "hackers"), ("3", "", "Our loans and one loan"), ("4", "strategy", "lawsuit litigation enforcement")], "risk_id string, heading string, body string")
    got = {x.risk_id: x for x in keywords.classify(df).collect()}
    assert sum(map(len, KEYWORDS.values())) == 150
    assert got["1"].category == "financial" and got["1"].margin == 0
    assert got["2"].category == "operational" and got["2"].score_operational == 3
    assert got["3"].score_financial == 3  # loan twice, loans once
    assert (got["4"].score_strategic, got["4"].score_regulatory) == (3, 5)  # lawsuit begins with law and laws too


@pytest.mark.parametrize(("name", "key"), [("KEYCORP/NEW", "KEYCORP"), ("CULLEN/FROST BANKERS, INC.", "CULLEN FROST BANKERS"), ("ACME INC /MD/", "ACME"), ("First Bank, N.A.", "FIRST BANK N A"), ("Old Holding Corp Inc", "OLD")])
def test_name_key(spark, name, key):
    assert spark.createDataFrame([(name,)], "n string").select(text.name_key(F.col("n"))).first()[0] == key


def test_quarantine_rules_are_independent(spark):
    raw = spark.createDataFrame(
        [("a", 1, "t", "c", 2022, 0, "", "short", "x" * 300, 10), ("b", 1, "t", "c", 2022, 1, "", "A proper heading", "tiny", 10), ("c", 1, "t", "c", 2022, 2, " f ", "A proper heading", "x" * 300, 10), ("d", 7, "t", "c", 2022, 0, "", None, "tiny", 10), ("e", 2, "t", "c", 2022, 0, "", "Another heading", "x" * 300, 10)],
        "risk_id string, cik int, ticker string, company_name string, fiscal_year int, risk_index int, filer_category string, heading string, body string, chars int",
    )
    q = warehouse.record_quarantine(raw, (7,))
    assert sorted((x.record_id, x.reason) for x in q.collect()) == [("a", "empty_heading"), ("b", "short_body"), ("c", "duplicate_heading_in_filing"), ("d", "empty_heading"), ("d", "excluded_company"), ("d", "short_body")]
    clean = warehouse.clean_records(raw, q, (2,))
    assert [(x.risk_id, x.filer_category, x.company_has_caveat) for x in clean.collect()] == [("e", None, True)]
    m = spark.createDataFrame([("e", "a", "2", "t", "2023", "0.5", "CARRIED_FORWARD", "y"), ("", "e", "2", "t", "2023", "x", "DROPPED", "")], "curr_id string, prev_id string, cik string, ticker string, fiscal_year string, similarity string, label string, review string")
    got = {x.risk_id: x for x in warehouse.clean_matches(m, clean).collect()}
    assert got["e"].prior_risk_missing and got["e"].prior_risk_id is None and got["e"].flagged_for_review is True
    assert got[None].prior_risk_id == "e" and got[None].flagged_for_review is None and got[None].similarity is None
    assert [x.record_id for x in warehouse.match_quarantine(m, clean).collect()] == ["e"]


def test_faults_are_noticed_but_shifted_labels_escape(spark):
    rows = [(f"{c}_{y}_{i}", c, y, i, f"Heading number {i} of {c}", "b" * 250, 270) for c in range(1, 4) for y in (2021, 2022) for i in range(12)]
    rec = spark.createDataFrame(rows, "risk_id string, cik int, fiscal_year int, risk_index int, heading string, body string, chars int")
    cats = rec.select("risk_id", F.when(F.col("risk_index") % 2 == 0, "financial").otherwise("strategic").alias("category"))
    matches = rec.where("fiscal_year = 2022").select(F.col("risk_id").alias("curr_id"), F.concat(F.col("cik").cast("string"), F.lit("_2021_"), F.col("risk_index").cast("string")).alias("prev_id"))
    inputs = {"records": rec, "categories": cats, "matches": matches, "unreadable": spark.createDataFrame([], "error string")}
    got = {}
    for x in faults.run(inputs).collect():
        got.setdefault(x.fault, []).append(x.name)
    assert got.pop("shifted_labels") == [None]
    assert all(None not in v for v in got.values()) and len(got) == 7
    assert "short_body" in got["empty_bodies"] and "duplicate_heading_in_filing" in got["duplicate_rows"] and "orphan_prior_risk" in got["broken_match_ids"]
    shifted = {x.risk_id: x.category for x in faults.shifted_labels(inputs)["categories"].collect()}
    before = {x.risk_id: x.category for x in cats.collect()}
    assert sorted(shifted.values()) == sorted(before.values()) and shifted != before


@pytest.mark.parametrize("reply", ["no json", "[]", '[{"id": 0, "category": "odd"}, {"id": 1, "category": "financial"}]', '[{"id": 0, "category": "financial"}, {"id": 0, "category": "financial"}]', '[{"id": 0, "category": "financial"}, {"id": 2, "category": "financial"}]', '{"id": 0}'])
def test_replies_are_checked(reply):
    with pytest.raises(external.Malformed):
        external.parse_reply(reply, 2)


def test_external_falls_back_to_single_items(spark):
    def client(prompt):
        n = prompt.count("\n\n[")
        return "sorry" if n > 1 or "bad" in prompt else json.dumps([{"id": 0, "category": "strategic"}])

    df = spark.createDataFrame([("1", "fine", "x"), ("2", "bad", "x"), ("3", None, None)], "risk_id string, heading string, body string")
    got = {x.risk_id: x for x in external.classify(df.coalesce(1), client, "say", "v1", "m", "t").collect()}
    assert got["1"].category == "strategic" and got["2"].category is None and got["2"].error and got["3"].category == "strategic"
    done = spark.createDataFrame([("1",), ("2",)], "risk_id string")
    assert [x.risk_id for x in external.classify(df, external.mock_client, "say", "v1", "m", "t", done=done).collect()] == ["3"]


def test_universe(spark):
    years = range(2021, 2026)
    history = [(c, "10-K", f"{c}-{y}", f"{y + 1}-02-01", f"{y}-12-31", "d.htm") for c in ("1", "2", "3") for y in years if (c, y) != ("2", 2023)]
    history += [("1", "10-K/A", "1-a", "2023-05-01", "2022-12-31", "d.htm"), ("1", "8-K", "x", "2023-01-01", "2023-01-01", "d")]
    h = spark.createDataFrame(history, "cik string, form string, accessionNumber string, filingDate string, reportDate string, primaryDocument string")
    reports = universe.annual_reports(h)
    assert reports.where("cik = '1' AND fiscal_year = 2022").first().amendment_accessions == "1-a"
    sizes = spark.createDataFrame([("1", "A", 30), ("2", "B", 20), ("3", "C", 10), ("4", "D", 5)], "cik string, name string, val long")
    companies = spark.createDataFrame([("1", "A", "6021"), ("2", "B", "6022"), ("3", "C", "6035")], "cik string, name string, sic string")
    chosen, index, out = universe.select(sizes, companies, reports, most=1, keep=lambda df: r.written(df, "ranges"))
    assert [x.cik for x in chosen.collect()] == ["1"] and index.count() == 5
    assert {x.cik: (x.reason, x.detail) for x in out.collect()} == {"2": ("incomplete_10k_history", "2023"), "3": ("below_size_rank_cutoff", "rank 2"), "4": ("no_submissions_json", "")}
    former = spark.createDataFrame([("1", "NEW NAME INC", [("OLD NAME CORP", "2010-01-01", "2022-05-05T00:00"), ("New Name, Inc.", "2000-01-01", "2023-01-01")]), ("9", None, None)], "cik string, name string, formerNames array<struct<name:string,`from`:string,to:string>>")
    got = {x.cik: x.signals for x in universe.continuity(former, reports).collect()}
    assert got == {"1": "first_10k_in_window;renamed_in_window", "9": "no_submissions_json"}


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,note\n1,"say ""x"", y"\n2,\n', encoding="utf-8")
    got = readers.csv_strings(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["id", "note"] and [tuple(x) for x in got.collect()] == [("1", 'say "x", y'), ("2", None)]
    assert readers.blank_as_empty(got).collect()[1].note == ""
    d = tmp_path / "docs"
    d.mkdir()
    (d / "good.json").write_text('{"cik": 1,\n "ticker": "T"}')
    (d / "bad.json").write_text('{"cik": 12, "risks": [{"hea')
    good, bad = readers.json_documents(spark, str(d), "cik long, ticker string")
    assert [x.ticker for x in good.collect()] == ["T"] and bad.count() == 1
    (tmp_path / "f.gz").write_bytes(gzip.compress("<p>é</p>".encode()))
    assert readers.compressed_documents(spark, str(tmp_path / "f.gz")).first().html == "<p>é</p>"
    (tmp_path / "m.jsonl").write_text('{"cik": 1, "http_status": 200, "stored_path": "x"}\nbroken\n{"cik": 2, "http_status": 404}\n')
    assert [x.cik for x in readers.manifest(spark, str(tmp_path / "m.jsonl"), "cik long, http_status int, stored_path string").collect()] == [1]


def test_streaming_ingestion_adds_each_id_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([("1", "a"), ("2", "b"), ("1", "a")], "risk_id string, heading string").write.json(src)
    for _ in range(2):
        follow(spark, src, "risk_id string, heading string", out, cp).awaitTermination()
    spark.createDataFrame([("2", "b"), ("3", "c")], "risk_id string, heading string").write.mode("append").json(src)
    follow(spark, src, "risk_id string, heading string", out, cp).awaitTermination()
    assert sorted(x.risk_id for x in spark.read.parquet(out).collect()) == ["1", "2", "3"]



def test_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y", z')], "k string, v string")
    sinks.csv_export(df, str(tmp_path / "c"), single=True)
    assert [tuple(x) for x in readers.csv_strings(spark, str(tmp_path / "c")).collect()] == [("a", 'x "y", z')]


def test_entry_and_driver_contract(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert e.oracle_sql().keys() <= names.keys()
    assert e.entry(spark).columns == ["theme", "fy2022", "fy2023", "fy2024", "fy2025"]
    assert r.records(spark, SF).count() == 200


def test_questions_over_the_layers(spark):
    layers = r.layers(spark, SF)
    n = warehouse.ask(layers, "SELECT count(*) AS n FROM mart_risk_factor m JOIN dim_company c USING (cik)").first().n
    assert n == layers["mart_risk_factor"].count()
    with pytest.raises(ValueError, match="only queries"):
        warehouse.ask(layers, "DROP VIEW mart_risk_factor")


@pytest.mark.parametrize("sql", ["WITH a AS (SELECT 1 AS x) INSERT INTO victim SELECT x FROM a", "FROM mart_risk_factor INSERT INTO victim SELECT cik", "CREATE TABLE t AS SELECT 1", "DROP VIEW mart_risk_factor", "SET x = 1"])
def test_ask_only_reads(spark, sql):
    layers = {"mart_risk_factor": spark.createDataFrame([(1,)], "cik int")}
    spark.sql("CREATE TABLE IF NOT EXISTS victim (x INT) USING parquet")
    with pytest.raises(ValueError, match="queries"):
        warehouse.ask(layers, sql)
    assert spark.table("victim").count() == 0
    asked = warehouse.ask(layers, "WITH a AS (SELECT cik FROM mart_risk_factor) SELECT cik, count(*) OVER () AS n FROM a WHERE cik IN (VALUES 1) ORDER BY cik LIMIT 3")
    assert [tuple(x) for x in asked.collect()] == [(1, 1)] and not spark.catalog.tableExists("mart_risk_factor")


def test_mock_answers_an_item_alike_in_every_batch(spark):
    rows = [(str(i), f"heading {'x' * (i % 7)}", f"body\n\n[{i}] not an item\n\n\n{'y' * (i % 5)}") for i in range(40)]
    df = spark.createDataFrame(rows, "risk_id string, heading string, body string")
    answers = [{x.risk_id: x.category for x in external.classify(d, external.mock_client, "say", "v1", "m", "t", batch=b).collect()} for d, b in ((df, 20), (df.repartition(7), 3), (df.coalesce(1), 40))]
    assert answers[0] == answers[1] == answers[2] and len(set(answers[0].values())) > 1 and None not in answers[0].values()


def test_dashboard_marks(spark):
    from textpanel.operators import analysis

    df = spark.createDataFrame([("NEW",), ("",), (None,)], "yoy_label string")
    assert [x.mark for x in analysis.marked(df).collect()] == [analysis.MARKS["NEW"], "", ""]
    assert analysis.MARKS == {"NEW": "🟢", "DROPPED": "🔴", "MATERIALLY_REVISED": "🟡", "CARRIED_FORWARD": "⚪", "AMBIGUOUS": "⚫"}


def test_earlier_audit_and_primary_document(spark):
    companies = spark.createDataFrame([("5", "A", [("Big Acquisition Corp", "", "")]), ("1950000", "B", []), ("7", None, None)], "cik string, name string, formerNames array<struct<name:string,`from`:string,to:string>>")
    history = spark.createDataFrame([("5", "2001-01-01"), ("1950000", "2022-01-01")], "cik string, filingDate string")
    assert {x.cik: x.signals for x in universe.short_histories(companies, history).collect()} == {"5": "SHELL_NAME", "1950000": "new_cik;short_history", "7": "no_submissions_json"}
    items = spark.createDataFrame([("1", "a", "ex-99.htm", 900), ("1", "a", "main.htm", 500), ("1", "a", "logo.jpg", 9999)], "cik string, accession string, name string, size long")
    assert universe.primary_document(items).first().document == "main.htm"


@pytest.fixture(scope="module")
def with_null_text(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, None if k == 7 else f"only{k} alpha beta\nbody {k}", "en", f"src{k % 2}", 20) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return d


def test_documents_without_text_have_their_reason(spark, with_null_text):
    got = {r.doc_id: r for r in registry.queries()["section_winner"](spark, with_null_text).collect()}
    assert len(got) == 30 and (got[7].ok, got[7].reason) == (False, "no_text") and got[10].ok


def test_all_terms_are_counted(spark, with_null_text):
    got = {(r.field, r.term): r.df for r in registry.queries()["doc_freq"](spark, with_null_text).collect()}
    assert got["heading", "alpha_beta"] == 29 and got["body", "body"] == 29 and min(got.values()) >= 1


def test_all_records_have_neighbours(spark, with_null_text):
    rec = r.records(spark, with_null_text).collect()
    want = sorted((a.risk_id, b.risk_index, a.risk_index - b.risk_index) for a in rec for b in rec if (a.cik, a.fiscal_year) == (b.cik, b.fiscal_year) and abs(a.risk_index - b.risk_index) <= 1)
    assert sorted((r.risk_id, r.target_index, r.distance) for r in registry.queries()["neighbour_records"](spark, with_null_text).collect()) == want


@pytest.mark.parametrize("sql", ["SELECT java_method('java.lang.System', 'setProperty', 'zz', '1') FROM some", "SELECT * FROM some WHERE id IN (SELECT CAST(reflect('java.lang.Math', 'abs', 1) AS INT))", "WITH a AS (SELECT try_reflect('java.lang.System', 'gc') AS x) SELECT * FROM a"])
def test_questions_reach_nothing_outside(spark, sql):
    with pytest.raises(ValueError, match="only queries"):
        warehouse.ask({"some": spark.range(3)}, sql)


def test_questions_of_all_kinds_and_views_that_stay(spark):
    spark.range(9).createOrReplaceTempView("some")
    ask = lambda sql: [tuple(r) for r in warehouse.ask({"some": spark.range(3), "other": spark.range(2)}, sql).collect()]
    assert ask("SELECT 1 AS x;") == [(1,)] and ask("SELECT /*+ BROADCAST(o) */ count(*) FROM some s JOIN other o USING (id)") == [(2,)]
    assert sorted(ask("SELECT id FROM some DISTRIBUTE BY id")) == [(0,), (1,), (2,)]
    assert ask("WITH a AS (SELECT max(id) AS m FROM some) SELECT m FROM a ORDER BY m -- the end") == [(2,)]
    assert ask("SELECT id FROM some ORDER BY id DESC LIMIT 2") == [(2,), (1,)]
    assert spark.table("some").count() == 9 and not [t for t in spark.catalog.listTables() if t.name.startswith("layer_")]
    spark.catalog.dropTempView("some")
