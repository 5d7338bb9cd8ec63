import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_blocks import vectors
from test_prefixes_and_ranks import KIND, some_rows
from textpanel.functions.packed import pack, unpack
from textpanel.operators import similarity
from textpanel.plans import records as r

SF = "/root/testdata/sf0.001"


def built(d):
    return {k[3] for k in r._built if k[1] == d}


def test_packed_numbers_come_back():
    arrays = [np.array([], np.int64), np.array([0]), np.array([2**64 - 1, 3, 0], np.uint64), np.arange(70_000) % 300]
    got = unpack(pack(*arrays))
    assert len(got) == 4 and all((a == np.asarray(b, np.uint64)).all() for a, b in zip(got, arrays, strict=True))


def test_terms_take_less_room_than_texts(spark, tmp_path):
    """F1-F3, F6-F13, F16: a term's hash isn't written for each record that has it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumns({"risk_id": F.col("doc_id").cast("string"), "cik": F.substring("source", 4, 9).cast("int"), "fiscal_year": (F.lit(2021) + F.expr("(doc_id div 20) % 5")).cast("int"), "heading": F.substring("text", 1, 40), "body": F.col("text")})
    similarity.hashed_terms(docs).write.parquet(f"{tmp_path}/terms")
    similarity.vectors_of(docs, spark.read.parquet(f"{tmp_path}/terms")).write.parquet(f"{tmp_path}/vectors")
    room = sum(os.path.getsize(os.path.join(a, f)) for a, _, files in os.walk(tmp_path) for f in files)
    assert room < 1.5 * docs.agg(F.sum(F.length("text"))).first()[0]


@pytest.mark.parametrize(("parts", "some"), [(1, 3), (9, 100)])
def test_records_in_small_chunks_give_the_same_pairs(spark, tmp_path, monkeypatch, parts, some):
    rows = [*some_rows(), ("n", 1, 2022, "", ""), ("m", 1, 2022, None, "waaaa")]
    df = spark.createDataFrame([*rows, (None, 1, 2021, "wa kaax", "wb"), (None, 1, 2021, "wa", None)], KIND).repartition(parts)
    similarity.hashed_terms(df).write.parquet(f"{tmp_path}/terms")
    terms = spark.read.parquet(f"{tmp_path}/terms")
    similarity.vectors_of(df, terms).write.parquet(f"{tmp_path}/vectors")
    v = spark.read.parquet(f"{tmp_path}/vectors")
    got = {(x.curr_id, x.prev_id): x.sim for x in similarity.edges_of(v, most_rows=some).collect()}
    norms = {(x.risk_id, x.field): x.norm for x in similarity.norms_of(df, terms).collect()}
    want = {(x.risk_id, x.field): x.norm for x in similarity.norms(similarity.weights(df)).collect()}
    assert norms.keys() == want.keys() and all(abs(norms[k] - want[k]) < 1e-9 for k in want)
    edges = {(x.curr_id, x.prev_id): x.sim for x in similarity.edges(similarity.weights(df)).where("curr_id IS NOT NULL AND prev_id IS NOT NULL").collect()}
    assert got.keys() == edges.keys() and all(abs(got[k] - edges[k]) < 1e-9 for k in edges)


def test_few_records_at_a_time_give_the_same_best_pairs(spark, tmp_path):
    v = vectors(spark, some_rows(), tmp_path)
    known = unpack(bytes(v.where("cik IS NULL").first().terms))
    side = lambda y: v.where(f"cik = 1 AND fiscal_year = {y}").select("risk_id", "terms").toArrow().sort_by("risk_id")
    now, before = side(2022), side(2021)
    key = (now.column("risk_id")[0], now.column("risk_id")[0])
    some, found = similarity.SOME, []
    try:
        for similarity.SOME in (3, 4096):
            t = similarity.best_pairs(key, now, before, similarity.products(now, before, lambda x: similarity._unpacked(x, known)), 0.03)
            found.append(sorted((x["curr_id"], x["prev_id"], round(x["sim"], 9)) for x in t.to_pylist()))
    finally:
        similarity.SOME = some
    assert found[0] == found[1] and found[0]


def test_categories_of_records_deal_out_no_texts(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    r.layer(spark, str(tmp_path), "clean_category")
    assert "scores" not in built(str(tmp_path)) and "baseline" in built(str(tmp_path))
