from pyspark.sql import functions as F

from textpanel.plans import registry


def test_page_queries_leave_references_without_a_semicolon(spark, tmp_path):
    spark.createDataFrame([(1, "<p>a &amp;&amp;&amp</p><p>b &lt c</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.queries()["page_blocks"](spark, str(tmp_path)).orderBy("idx").collect()
    assert [x.text for x in got] == ["a &&&amp", "b &lt c"]


def test_each_reference_is_decoded_once(spark):
    import time

    from textpanel.functions import html

    kinds = ["&amp;", "&eacute;", "&#233;", "&#x80;", "&", "&nosuch;", "&ampamp;", "&Tab;", "&#;", "&#0;", "&NotEqualTilde;"]
    df = spark.createDataFrame([("x" + " y".join(kinds[i % len(kinds)] for i in range(4_400)),)], "t string")
    began = time.monotonic()
    bare, closed = df.select(html.decoded(F.col("t")), html.decoded(F.col("t"), False)).first()
    assert time.monotonic() - began < 30
    assert bare == "x" + " y".join(["&", "é", "é", "€", "&", "&nosuch;", "&amp;", "\t", "&#;", "�", "≂̸"] * 400)
    assert closed == "x" + " y".join(["&", "é", "é", "€", "&", "&nosuch;", "&ampamp;", "\t", "&#;", "�", "≂̸"] * 400)
