import random

from pyspark.sql import functions as F

from test_prefixes_and_ranks import KIND, brute_edges, some_rows
from textpanel.operators import keywords, similarity
from textpanel.plans import records as r
from textpanel.plans import registry


def vectors(spark, rows, folder):
    df = spark.createDataFrame(rows, KIND)
    for name, make in (("terms", lambda: similarity.hashed_terms(df)), ("vectors", lambda: similarity.vectors_of(df, spark.read.parquet(f"{folder}/terms")))):
        make().write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/vectors")


def test_best_pairs_of_blocks_are_those_of_all_pairs(spark, tmp_path):
    rows = some_rows()
    v = vectors(spark, rows, tmp_path)
    want = brute_edges(rows)
    got = {(x.curr_id, x.prev_id): x.sim for x in similarity.edges_of(v, most_rows=7).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    near = {(x.curr_id, x.prev_id): x.sim for x in similarity.nearest(v, v, most_rows=7).collect()}

    def best(edges, side):
        out = {}
        for k, sim in edges.items():
            out[k[side]] = max(out.get(k[side], (0, "")), (round(sim, 11), k[1 - side]))
        return out

    for side in (0, 1):
        found, wanted = best(near, side), best(want, side)
        assert found.keys() == wanted.keys()
        assert all(found[k][1] == wanted[k][1] and abs(found[k][0] - wanted[k][0]) < 1e-9 for k in wanted)


def test_copies_are_equally_near(spark, tmp_path):
    luck = random.Random(5)
    words = lambda n: " ".join(luck.choice("abcdefghijklm") * luck.randint(1, 3) for _ in range(n))
    heading, body = words(6), words(300)
    rows = [(f"{y}-{i}", 1, y, heading, body) for y in (2021, 2022) for i in range(9)] + [(f"{y}-o{i}", 1, y, words(6), words(300)) for y in (2021, 2022) for i in range(30)]
    v = vectors(spark, rows, tmp_path)
    copies = similarity.edges_of(v).where(~F.col("prev_id").contains("o")).groupBy("curr_id").agg(F.countDistinct("sim").alias("n"))
    assert {x.n for x in copies.collect()} == {1} and copies.count() == 39


def test_layers_without_matches_look_for_none(spark, tmp_path):
    rows = [(i, f"heading number {i}\n{'body ' * 60}", "en", f"src{i % 3}", 5) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("clean_records", "dim_company", "dim_year"):
        registry.queries()[name](spark, str(tmp_path)).count()
    assert not {k[3] for k in r._built if k[1] == str(tmp_path)} & {"terms", "vectors", "labels", "matches", "edges", "deciding-edges"}


def test_words_that_are_remembered_cost_later_texts_nothing():
    import time

    import pyarrow as pa

    batch = lambda texts: pa.RecordBatch.from_pydict({"row": list(range(len(texts))), "heading": texts, "body": texts})
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    found = similarity.hashed_counts(iter([batch([" ".join(name(i) for i in range(150_000))]), batch(["aaaa baaa"] * 2000)]))
    next(found)
    began = time.monotonic()
    assert next(found).num_rows == 2000 * 2 * 3 and time.monotonic() - began < 3


def test_frequencies_are_those_of_counts_and_nameless_records_are_one(spark):
    rows = [("a", 1, 2021, "Red red tape", "tape red"), ("b", 1, 2022, None, ""), (None, 1, 2021, "red sky", "sky"), (None, 1, 2021, "Red", "sky sky"), (None, None, None, "red", None)]
    df = spark.createDataFrame(rows, KIND)
    flat = lambda x: sorted((r.field, r.term, r.df) for r in x.collect())
    assert flat(similarity.frequencies_of(df)) == flat(similarity.document_frequencies(similarity.term_counts(df)))


def test_texts_of_records_are_written_once(spark, monkeypatch):
    names, write = [], r.written
    monkeypatch.setattr(r, "written", lambda df, name: names.append((name, df.columns)) or write(df, name))
    docs = [(i % 7 or None, f"title {i % 3}\nbody {i}", "en", f"src{i % 2}", 9) for i in range(60)]
    df = r.adapt(spark.createDataFrame([*docs, *docs[:4]], "doc_id long, text string, lang string, source string, n_chars long"))
    got = [(x.risk_id, x.cik, x.fiscal_year, x.risk_index, x.doc_id) for x in df.collect()]
    assert [n for n, columns in names if "body" in columns or "text" in columns] == ["rows"] and "records" not in [n for n, _ in names]
    years = {}
    for _, cik, year, i, doc in got:
        years.setdefault((cik, year), []).append((i, doc or 0))
    assert len(got) == 64
    for x in years.values():
        x.sort()
        assert [i for i, _ in x] == list(range(len(x))) and [d for _, d in x] == sorted(d for _, d in x)
    d = "/root/testdata/sf0.001"
    r.records(spark, d)
    assert "records" not in [n for n, _ in names]


def test_vectors_are_shuffled_once_for_their_blocks(spark, tmp_path):
    v = vectors(spark, some_rows(), tmp_path)
    plan = similarity.edges_of(v)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_texts_are_scored_before_records_are_put_in_order(spark, monkeypatch, tmp_path):
    docs = [(i % 7 or None, f"the title {i % 3}\nand a body, que {'der ' * (i % 5)}" if i % 9 else None, "en", f"src{i % 2}", 9) for i in range(60)]
    rows = spark.createDataFrame([*docs, *docs[:4]], "doc_id long, text string, lang string, source string, n_chars long")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    flat = lambda df: sorted(map(repr, df.collect()))
    columns = ["risk_id", "category", "margin", *[f"score_{c}" for c in r.TERMS]]
    records = r.adapt(rows)
    few, every = (keywords.classify(records, terms, edge=r.EDGE).select(columns) for terms in (r.TERMS, None))
    names, write = [], r.written
    monkeypatch.setattr(r, "written", lambda df, name: names.append((name, df.columns)) or write(df, name))
    assert registry.queries()["category_frequencies"](spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 64
    assert "firsts" not in [n for n, _ in names]
    assert flat(r.baseline(spark, str(tmp_path)).select(columns)) == flat(few)
    assert set(flat(every)) <= set(flat(registry.queries()["keyword_150_scores"](spark, str(tmp_path)).select(columns)))
    assert names and not any({"text", "heading", "body"} & set(c) for _, c in names)
