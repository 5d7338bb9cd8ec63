import math
import random
import re

import pytest
from pyspark.sql import functions as F

from textpanel.constants import KEYWORDS
from textpanel.functions.ranks import numbered
from textpanel.functions.text import keyword_pattern
from textpanel.operators import keywords, similarity
from textpanel.plans import records as r

KIND = "risk_id string, cik int, fiscal_year int, heading string, body string"


def brute_edges(rows, floor=0.03):
    """All pairs of a company's records of two years, product by product."""

    def grams(text):
        w = re.findall("[a-z]+", text.lower())
        return w + [f"{a}_{b}" for a, b in zip(w, w[1:], strict=False)]

    tf = {(x[0], f): {t: g.count(t) for t in set(g)} for x in rows for f, g in (("h", grams(x[3])), ("b", grams(x[4])))}
    df = {}
    for (_, f), terms in tf.items():
        for t in terms:
            df[f, t] = df.get((f, t), 0) + 1
    unit = {}
    for (k, f), terms in tf.items():
        w = {t: (1 + math.log(n)) * (math.log((len(rows) + 1) / (df[f, t] + 1)) + 1) for t, n in terms.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        unit[k, f] = {t: x / norm for t, x in w.items()}
    out = {}
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[2] == b[2] + 1:
                sim = sum(share * sum(x * unit[b[0], f].get(t, 0) for t, x in unit[a[0], f].items()) for f, share in (("h", 0.7), ("b", 0.3)))
                if sim > floor:
                    out[a[0], b[0]] = sim
    return out


def some_rows():
    luck = random.Random(3)
    common, rare = [f"w{'abcdefgh'[i]}" for i in range(8)], [f"{a}{b}{c}x" for a in "klmnop" for b in "aeiou" for c in "rstv"]
    text = lambda n: " ".join(luck.choice(common) if luck.random() < 0.5 else luck.choice(rare) for _ in range(n))
    return [(f"r{i}", luck.choice([1, 1, 1, 2]), luck.choice([2021, 2022, 2022, 2023]), text(luck.randint(0, 5)), text(luck.randint(0, 60))) for i in range(160)]


@pytest.mark.parametrize(("most_rows", "block"), [(3, 4), (4096, 128)])
def test_edges_are_all_pairs_above_the_floor(spark, tmp_path, monkeypatch, most_rows, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rows = some_rows()
    df = spark.createDataFrame(rows, KIND)
    written = iter(range(99))

    def keep(df):
        path = f"{tmp_path}/{next(written)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    got = {(x.curr_id, x.prev_id): x.sim for x in similarity.edges(similarity.weights(df), keep=keep, most_rows=most_rows).collect()}
    want = brute_edges(rows)
    assert got.keys() == want.keys() and len(want) > 500
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_prefixes_leave_out_what_cannot_reach_the_floor(spark):
    luck = random.Random(8)
    own = lambda: "".join(luck.choices("bcdfgh", k=7))
    rows = [(f"{y}-{i}", 1, y, own(), " ".join(["shared", "common", "words"] + [own() for _ in range(60)])) for y in (2021, 2022) for i in range(120)]
    rows += [(f"2022-c{i}", 1, 2022, rows[i][3], rows[i][4]) for i in range(10)]
    df = spark.createDataFrame(rows, KIND)
    whole = similarity.whole_vectors(similarity.weights(df))
    found = similarity.candidates(whole, lambda df: df)
    assert found.count() < 0.1 * 120 * 130
    assert {(x.curr_id, x.prev_id) for x in similarity.edges(similarity.weights(df)).collect()} >= {(f"2022-c{i}", f"2021-{i}") for i in range(10)}


TEXTS = ["Loans and loan\n portfolio; SEC  filings, the sec", "charge-off charge off\tcharged", "third party third-party third  party vendor", "outlaw lawsuit laws law_x law", None, "", "a a a a", "environmental, social and esg", "Überlaw 1law law1", "key employees' credit risk credit risk"]


@pytest.mark.parametrize("edge", [keywords.EDGE, r.EDGE])
def test_terms_in_one_pass_as_one_by_one(spark, edge):
    luck = random.Random(4)
    every = [t for terms in KEYWORDS.values() for t in terms]
    texts = TEXTS + ["".join(luck.choice(every) + luck.choice([" ", "s ", "\n", "-", "", "_", "  "]) for _ in range(40)) for _ in range(60)]
    terms = [*every, "a a", "a", "law", "law", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lower = F.lower(F.coalesce("t", F.lit("")))
    one_by_one = sum((F.regexp_count(lower, F.lit(keyword_pattern(t.lower(), edge))) for t in terms if t), F.lit(0))
    got = df.select("i", keywords.hits(F.col("t"), terms, edge).alias("n"), one_by_one.alias("want")).collect()
    assert [x.n for x in got] == [x.want for x in got] and sum(x.n for x in got) > 500


def test_each_field_is_read_by_one_pattern(spark):
    plan = keywords.classify(spark.createDataFrame([("a", "b")], "heading string, body string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2 and "regexp_count(" not in plan


def test_ranks_in_two_steps(spark, tmp_path):
    luck = random.Random(1)
    rows = [(luck.choice([None, "a", "b", "b", "b"]), luck.choice([None, 1, 2, 3]), i) for i in range(500)]
    written = iter(range(9))

    def keep(df):
        path = f"{tmp_path}/{next(written)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    df = spark.createDataFrame(rows, "g string, o int, i int")
    order = lambda x: (x[1] is not None, x[1] or 0, x[2])
    got = {x.i: x.nth for x in numbered(df, ["g"], ["o", "i"], keep, slices=7).collect()}
    assert got == {x[2]: sorted((y for y in rows if y[0] == x[0]), key=order).index(x) + 1 for x in rows}
    whole = {x.i: x.nth for x in numbered(df, [], ["o", "i"], keep, slices=7).collect()}
    assert whole == {x[2]: n + 1 for n, x in enumerate(sorted(rows, key=order))}


def test_records_keep_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "no id", "en", "src1", 5), (4, "one\nrest", "en", "src1", 8), (4, "two", "en", "src1", 3), (4, "two", "en", "src1", 3), (5, None, "en", "src1", 0), (6, "x", None, None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = r.records(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id or 0, x.heading or "") for x in got) == sorted((d or 0, (t or "").split("\n")[0]) for d, t, *_ in rows)
    assert sorted(x.risk_id for x in got if x.cik == 1 and x.fiscal_year) == [f"src1_FY2021_00{i}" for i in range(4)]


def test_records_are_made_anew_when_the_folder_changes(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for n in (1, 4):
        spark.createDataFrame([(i, f"t{i}", "en", "src1", 2) for i in range(n)], kind).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert r.records(spark, str(tmp_path)).count() == n
