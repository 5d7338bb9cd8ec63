"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textpanel.llm import attribution, idfile, jaccard, langid, mixing, packing, quality, secrets, topk, toxicity
from textpanel.llm.common import fresh_path, held_out, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Ein langer Satz mit vielen Worten steht hier. " * 6000
EN = "The members of the board are asked to read the notes, and to send their answers before the end of the week. "
FR = "Les membres du conseil doivent lire les notes, et envoyer leurs réponses avant la fin de la semaine prochaine. "
ROWS = [
    (1, EN * 4, "en", "a", 1),
    (1, EN * 4, "en", "a", 1),
    (2, None, "en", "b", None),
    (3, "", None, None, 0),
    (4, "   \n\t ", "en", "a", 3),
    (5, LONG, "de", "a", 5),
    (6, FR * 4, "fr", None, 6),
    (None, FR * 3, "fr", "c", 7),
    (8, "1234 5678 !!", "en", "", 8),
    (9, None, None, None, None),
    (10, "word", "en", "b", 4),
    (11, "漢字 и кириллица <|endoftext|> \x00   x", "xx", "b", 4),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module", params=["rows", "clash", "empty"])
def docs(request, spark):
    df = spark.createDataFrame(ROWS if request.param != "empty" else [], SCHEMA)
    if request.param == "clash":
        names = "row key rep root size target gone_key keep_n is_gone copies bucket place slice n_words kept q_text score lang_pred digest spans length sequence_id offset text_of labels"
        df = df.withColumns({c: F.lit("own") for c in names.split()})
    return df


def n_rows(docs):
    return docs.count()


def test_packing(docs):
    pieces = stored(packing.token_pieces(docs, P.path("byte_bpe_50k.json")), "t")
    out = packing.pack(pieces, order=("doc_id", "piece", "start", "ids_crc32")).toPandas()
    assert len(out[out.piece == 0]) == n_rows(docs)
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 2048 and list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    if len(out):
        empty = out[(out.doc_id == 2)].iloc[0]
        assert empty.length == 1 and empty.ids_crc32 == zlib.crc32(b"\0\0\0\0")


def test_packing_keeps_clashing_columns(spark):
    df = spark.createDataFrame([(3, "x", 1, 1, 1), (5, "y", 2, 2, 2)], "length long, bucket string, ahead int, place int, rank int")
    out = packing.pack(df)
    assert {"bucket", "ahead", "place", "sequence_id", "offset"} <= set(out.columns) and out.count() == 2
    df = df.withColumns({"length_of": F.lit(5), "sequence_id": F.lit("own"), "offset": F.lit("own")})
    out = packing.pack(df, names=("seq", "off")).collect()
    assert all((r.length_of, r.sequence_id, r.offset) == (5, "own", "own") and r.off in (0, 3, 5) for r in out)
    assert all(isinstance(r.offset, int) for r in packing.pack(df).collect())


def test_equal_pieces_are_spread(spark):
    docs = spark.createDataFrame([(None, "")] * 3000, "doc_id long, text string").repartition(6)
    out = packing.packed_documents(docs, P.path("byte_bpe_50k.json")).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == 3000 and len({r.sequence_id for r in out}) == 2


def test_jaccard(docs):
    out = jaccard.jaccard_join(docs).collect()
    assert len(out) == n_rows(docs)
    if out:
        by = {}
        for r in out:
            by.setdefault(r.doc_id, []).append(r)
        assert [(r.n_links, r.class_id) for r in by[1]] == [(1, 1), (1, 1)]
        assert all(r.n_links == 0 and r.class_id == k for k in (2, 3, 4, 9, 10) for r in by[k])
        # Three and four times the same sentence are the same set of n-grams; one of the ids is null.
        assert by[6][0].n_links == 1 and by[6][0].class_id == 6
        assert sorted(r.n_links for r in by[None]) == [0, 1]
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (6, 1, 0), (5, None, None), (77, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        out = toxicity.score(docs, toxicity.train(docs, some, F.lit(True))).collect()
        assert len(out) == n_rows(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_mixing(docs):
    out = mixing.mix(docs)
    got = out.collect()
    assert len(got) == n_rows(docs) and all(0 <= r.copies <= 2 for r in got)
    assert mixing.repeat_rows(out).count() == sum(r.copies for r in got)
    assert set(docs.columns) <= set(out.columns)
    words = {1: 88, 2: 0, 3: 0, 4: 0, 10: 1}
    assert all(r["size"] == words[r.doc_id] for r in got if r.doc_id in words)
    other = mixing.mix(docs, names=("m1", "m2", "m3", "m4")).collect()
    assert all(r["size"] == r["target"] == "own" for r in other if "size" in docs.columns)
    key = lambda rows, c: sorted((str(r.doc_id), str(r.text), r[c]) for r in rows)
    assert key(got, "copies") == key(other, "m4")


def test_mixing_helpers_meet_no_column_of_the_caller(spark):
    rows = [(i, f"{'w ' * (i % 7)}", f"s{i % 3}") for i in range(200)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    odd = plain.withColumns({c: F.lit(7) for c in ("mix_nth", "mix_from", "nth", "begin", "at", "unit", "size_class", "of_class", "slice")})
    got = [sorted((r.doc_id, r.copies) for r in mixing.mix(d).collect()) for d in (plain, odd)]
    assert got[0] == got[1] and {r.nth for r in mixing.mix(odd).collect()} == {7}


def test_quality(docs):
    out = quality.quality(docs).collect()
    assert len(out) == n_rows(docs)
    for r in out:
        if not (r.text or "").strip():
            assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (0, 0, 0, 0, True, False)


def test_attribution(docs):
    out = attribution.attribute(docs, P.path("byte_bpe_50k.json")).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(r.n == 0 for r in out if r.doc_id in (2, 3, 9))


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (None, [1.0, 1.0]), (8, [1.0]), (9, [-1.0, 0.0001]), (9, [-1.0, 0.0001]), (100, [3e30, 3e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"query": F.lit(1), "part": F.lit(2), "v": F.lit(3)})
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got[:5] == [(0, 1, 100, 2**63 - 1), (0, 2, 1, 1024**2 + 512**2), (0, 3, 2, 1024**2 + 512**2), (0, 4, 9, -(1024**2)), (0, 5, 9, -(1024**2))]
    assert topk.search(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_secrets(docs):
    out = secrets.secrets(docs).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert len(out) == n_rows(docs) and all((r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (0, 0, 0, none, "") for r in out)
    text = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    assert secrets.redact(docs).columns == docs.columns and text(secrets.redact(docs)) == text(docs)
    key = "api_key = 'abcdefghijkl0123456789'"
    more = docs.withColumn("text", F.concat(F.lit(f"{key} "), "text"))
    got, old = secrets.redact(more).collect(), docs.collect()
    assert sorted(str(r.text) for r in got) == sorted("None" if r.text is None else f"<assign>' {r.text}" for r in old) or len({r.source for r in old}) > 2
    if old:
        # Five owners (null and "" among them) have the same value: a copied example.
        assert text(secrets.redact(more)) == text(more)
        assert all(r.n_copied == 1 and r.n_live == 0 for r in secrets.secrets(more).collect() if r.spans)


def test_id_files(spark, docs):
    folder = fresh_path(spark, "ids")
    files = idfile.write(docs, folder, P.path("word_bpe_49k.json"))
    out = idfile.read(spark, folder, with_ids=True).orderBy("part", "nth").collect()
    assert [r.key for r in out] == sorted((r.doc_id for r in docs.select("doc_id").collect()), key=lambda k: (k is not None, k or 0))
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 1 and r.ids_crc32 == zlib.crc32(r.ids) for r in out)
    assert files.count() == (1 if out else 0)


def test_language(docs):
    model = langid.train(docs, ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    out = langid.predict(docs, model, ["doc_id"]).collect()
    assert len(out) == n_rows(docs) and all(0 <= r.score <= 1 for r in out)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (2, 3, 4, 8, 9))
    assert langid.identified(docs, model).columns == docs.columns


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, docs, stage):
    name, f = corpus_pipeline.STAGES[stage]
    src = spark.read.parquet((lambda p: (docs.write.parquet(p), p)[1])(fresh_path(spark, "in")))
    out = f(spark, src, "nowhere")
    out.write.parquet(fresh_path(spark, "out"))
    rows, old = out.collect(), docs.collect()
    if stage < 4:
        assert out.columns == docs.columns
        own = [c for c in docs.columns if c not in ("text", "n_chars")]
        keep = lambda rows: {tuple(str(r[c]) for c in own) for r in rows}
        assert keep(rows) <= keep(old)  # the caller's values come back
    ids = sorted(str(r.doc_id) for r in rows)
    if not old:
        assert rows == []
    elif stage == 0:
        assert not {"2", "3", "4", "8", "9"} & set(ids) and {r.text for r in rows} <= {r.text for r in old}
    elif stage == 1:
        assert ids == sorted(["1", "2", "3", "4", "5", "8", "9", "10", "11", "None", "None"])
    elif stage == 2:
        assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in old) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    elif stage == 3:
        sizes = {s: sum(len((r.text or "").split()) for r in old if r.source == s) for s in {r.source for r in old}}
        assert all(ids.count(i) <= 2 * sum(str(r.doc_id) == i for r in old) for i in set(ids)) and sizes
    else:
        assert len([r for r in rows if r.piece == 0]) == len(old) and all(r.length == 1 for r in rows if r.doc_id in (2, 3, 9))


A, B = ("one two three four five six seven", "red green blue black white grey brown")


def survivors(spark, rows):
    return sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)


@pytest.mark.parametrize("x, y", [(A, B), (B, A)])
def test_one_of_each_keeps_classes_not_ids(spark, x, y):
    assert survivors(spark, [(None, x), (None, x), (None, y)]) == sorted([(None, x), (None, y)], key=str)
    assert survivors(spark, [(5, x), (5, y), (1, y)]) == sorted([(1, y), (5, x)], key=str)
    # Texts without words are classes of their own, repeated or not.
    assert len(survivors(spark, [(None, ""), (None, ""), (None, None), (3, " "), (3, " "), (3, x), (4, x)])) == 6


def test_one_of_each_takes_one_of_repeated_rows(spark):
    rows = [(7, A, "b", {"k": 1}), (7, A, "a", {"k": 1}), (7, A, "c", None), (7, B, "c", None), (8, B, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, m map<string,int>")
    got = sorted((r.doc_id, r.text, r.lang) for r in jaccard.one_of_each(df).collect())
    assert got == sorted([(7, A, "a"), (7, B, "c")])


def test_gram_sets_reads_a_wanted_text_not_all_of_its_id(spark):
    texts = [f"{A} {n} {n} {n} {n} {n}" for n in range(12)]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    sign = df.select(F.concat(F.md5("text"), F.length("text").cast("string"))).toDF("sign").collect()
    wanted = [(k, None, s.sign, jaccard.digest(jaccard.grams(t)), 1, [1, 2], [(-1, 0, 1)]) for k, (t, s) in enumerate(zip(texts, sign, strict=True))]
    w = spark.createDataFrame(wanted, "rep long, rep_key long, rep_sign string, digest string, copies long, bands array<long>, meets array<struct<band: int, place: long, blocks: int>>")
    sets = jaccard.gram_sets(df, w, "doc_id", "text")
    assert sorted(r.rep for r in sets.select("rep").collect()) == list(range(12))
    joined = sets._jdf.queryExecution().analyzed().children().head()
    assert spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, joined).count() == 12


def test_topk_takes_all_vectors_of_a_query_id(spark, monkeypatch):
    import duckdb

    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in zip([0, 0, 0, 100, 100, *range(1, 60)], rng.normal(size=(64, 4)), strict=True)]
    rows.append(rows[3])
    path = fresh_path(spark, "vectors")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(topk.ORACLE).fetchall())
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "PART", 16)
    got = topk.search(spark.read.parquet(path), F.col("id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want
