import pages_by_parser
from pyspark.sql import functions as F

from textpanel.functions import html
from textpanel.operators import sections, splitting

PROSE = "This paragraph explains the matter at some length and goes on for long enough to count as the body of a record. " * 3


def runs(spark, texts):
    """(text, bold) pairs as the runs of one document."""
    rows = [(1, i, t, b, False, False, None, i * 100) for i, (t, b) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc int, idx int, text string, bold boolean, italic boolean, underline boolean, font_size double, start int")


def records(spark, texts):
    return [(r.heading, r.category, r.body) for r in splitting.split(runs(spark, texts), ["doc"])[0].orderBy("risk_index").collect()]


def test_records_with_category_and_orphan_punctuation(spark):
    got = records(spark, [("Item 1A. Risk Factors", True), ("CREDIT RISKS", True), ("Our exposure may be affected", True), (", and deeply.", True), (PROSE, False), ("Losses could grow quickly.", True), (PROSE, False), ("more of it", False)])
    assert got == [("Our exposure may be affected, and deeply.", "CREDIT RISKS", PROSE.strip()), ("Losses could grow quickly.", "CREDIT RISKS", PROSE.strip() + " more of it")]


def test_running_headers_go_and_small_words_stay(spark):
    texts = [("We may lose money.", True)]
    for i in range(3):
        texts += [(PROSE, False), (f"{27 + i} Acme Bancorp Group", False), ("of", True), ("we", True)]
    s = splitting.steps(runs(spark, texts), ["doc"])
    gone = [r.text for r in s["furniture"].where("is_furniture").orderBy("idx").collect()]
    assert gone == ["27 Acme Bancorp Group", "28 Acme Bancorp Group", "29 Acme Bancorp Group"]


def test_category_does_not_close_a_record(spark):
    got = records(spark, [("First heading stands here.", True), (PROSE, False), ("OTHER RISKS", True), ("Second heading stands here.", True), (PROSE, False)])
    assert [(h, c) for h, c, _ in got] == [("First heading stands here.", None), ("Second heading stands here.", "OTHER RISKS")]


def test_emphasis_within_a_sentence_is_no_heading(spark):
    got = records(spark, [("A real heading opens this.", True), (PROSE, False), ("Regulation and Supervision", True), ("in Part I of this report. " + PROSE, False)])
    assert len(got) == 1 and "Regulation and Supervision in Part I" in got[0][2]


def test_summary_is_dropped_up_to_the_first_sentence(spark):
    texts = [("Risk Factor Summary", True), (PROSE, False), ("Credit Risks", True), (PROSE, False), ("Deteriorating credit quality has hurt and may again hurt our results.", True), (PROSE, False)]
    texts += [(f"Heading number {chr(97 + i)} is a full sentence here.", True) if k == 0 else (PROSE, False) for i in range(8) for k in range(2)]
    got = records(spark, texts)
    assert got[0][0].startswith("Deteriorating") and len(got) == 9


def page(spark, text):
    """A page's text and runs."""
    df = spark.createDataFrame([(1, text)], "id int, html string")
    found = html.runs(df, "id")
    return html.texts(df, found, "id").first().text, [tuple(r)[2:] for r in found.orderBy("idx").collect()]


def test_unclosed_bold_ends_with_its_paragraph(spark):
    text, got = page(spark, "<body><p>one <b>two<p>three <i>four</i> five</body><!-- no --><script>x()</script>tail")
    assert text == "one two three four five tail"
    assert [(r[0], r[1], r[2]) for r in got] == [("one", False, False), ("two", True, False), ("three", False, False), ("four", False, True), ("five", False, False), ("tail", False, False)]
    assert all(text[r[6] : r[7]] == r[0] for r in got)


def test_inherited_and_nearest_styles(spark):
    _, got = page(spark, '<div style="font-weight:700;font-size:16px;text-align:center">a<span style="font-size:2em;font-style:italic">b</span>c</div><td>x</td>')
    assert [(r[0], r[1], r[2], r[4], r[5]) for r in got] == [("a", True, False, 12.0, "center"), ("b", True, True, 24.0, "center"), ("c", True, False, 12.0, "center"), ("x", False, False, None, None)]


def test_words_split_across_inline_tags_stay_whole(spark):
    assert page(spark, "<p>UN<b>RESOLVED</b> ST<i>AFF</i></p><p>x</p>")[0] == "UNRESOLVED STAFF x"


ODD_PAGES = [
    "a &lt;b&gt; &amp;amp; &nbsp;&#160;&#x41;&#128;&copy &copyx; &notin; &notit; &unknown; &#0; & &#xD800;z&#99999999999;&#x1F600;&#7;&#38;amp;",
    "", "   ", "<ul><li>a<li><b>b<ul><li>c</ul>d</ul>e", "<table><tr><td><b>x<td>y<tr><th>z</table>w", "a < b << c", "<p/>x<br/>y<B STYLE='font-size:11px'>z</B>", "  lead <i> mid </i> trail  ",
    "<dl><dt>t<dd>d<dt>u</dl>", "<select><option>a<option><u>b</select>c", "</p></b>x</div>y", "<a title='>'>q</a><a title=\"<b>\">r</a>", "<b><p>x<b>y</b></p>z</b>w", "<script>if (a<b) x('</p>')</script>k<style>p{}</style>l",
    "<div>" * 300 + "deep" + "</div>" * 299 + "<i>er" + "x<br>" * 300, "<p style=font-size:9px;text-align:RIGHT>u <span style='text-decoration: none underline'>v", "x\u00a0\u2003y\u3000<b>\u200bz</b>",
]


def test_pages_as_the_standard_parser_reads_them(spark):
    rows = [(i, t) for i, t in enumerate(ODD_PAGES)] + [(1000 + r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html").collect()]
    df = spark.createDataFrame([*rows, (-1, None)], "id long, html string")
    found = html.runs(df, "id").cache()
    got = {}
    for r in found.orderBy("id", "idx").collect():
        got.setdefault(r.id, []).append(tuple(r)[2:])
    read = {r.id: r for r in html.texts(df, found, "id").collect()}
    for i, t in rows:
        text, runs = pages_by_parser.runs_of(t)
        assert (got.get(i, []), read[i].text, read[i].ok) == (runs, text, True), t[:200]
    assert (read[-1].ok, read[-1].reason, read[-1].text) == (False, "file_missing", None) and -1 not in got


def test_a_page_that_breaks_off_in_a_tag_or_a_comment(spark):
    assert page(spark, "a <b>b <c title=")[0] == "a b" and page(spark, "x<!-- un")[0] == "x" and page(spark, "y<script>z")[0] == "y"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t, True, None) for i, t in enumerate(texts)], "id int, text string, ok boolean, reason string")


CONTENTS = "Item 1A. Risk Factors 12 Item 1B. Unresolved Staff Comments 30 Item 2. Properties 31 "
SECTION = "ITEM 1A. RISK FACTORS We are subject to many risks. " + "Some words on them. " * 600


def test_section_between_contents_and_references(spark):
    text = CONTENTS + "For more see Item 1A. Risk Factors below. " + SECTION + "As noted, refer to Item 1C of this report. " + "Some words on them. " * 6 + "ITEM 1B. - UNRESOLVE D STAFF COMMENTS None."
    w = sections.winners(docs(spark, text, "nothing here", "Item 1A. Risk Factors short. Item 1B. Unresolved Staff"), "id").orderBy("id").collect()
    assert w[0].ok and text[w[0].pos :].startswith("ITEM 1A. RISK FACTORS We") and text[w[0].section_end :].startswith("ITEM 1B.") and w[0].stop_by == "1B"
    assert not w[1].ok and w[1].reason == "no_item_1a_match"
    assert not w[2].ok and w[2].reason.startswith("no_viable_candidate")


def test_section_without_an_end_runs_on(spark):
    w = sections.winners(docs(spark, SECTION), "id").first()
    assert w.ok and w.stop_by is None and w.section_chars == len(SECTION)


def test_terminators_out_of_order(spark):
    text = "Item 1B. Unresolved Staff Comments None. " + SECTION + "Item 3. Legal Proceedings none. Item 2. Properties"
    assert sections.winners(docs(spark, text), "id").first().stop_by == "3"


def test_stream_has_what_stands_around_a_place(spark):
    text = "x" * 300 + " item 2 item\n1a: Risk  Factors é" + "y" * 250 + "Item 1B"
    got = sections.stream(docs(spark, text, None, ""), "id").orderBy("id", "nth").collect()
    assert [(r.id, r.which) for r in got] == [(0, "2"), (0, "start"), (0, "1B"), (1, None), (2, None)]
    for r in got[:3]:
        assert text[r.pos : r.stop] == r.heading and text[max(0, r.pos - 90) : r.pos] == r.before90 and text[r.stop : r.stop + 200] == r.after
        assert text[max(0, r.pos - 80) : r.pos] == r.before80 and text[r.pos : r.pos + 60] == r.here60 and text[r.stop : r.stop + 60] == r.after60


def test_many_short_places_in_a_row(spark):
    text = "item2" * 300
    got = sections.stream(docs(spark, text), "id").orderBy("nth").collect()
    assert len(got) == 0 or all(text[r.pos : r.stop] == r.heading and text[max(0, r.pos - 90) : r.pos] == r.before90 and text[r.stop : r.stop + 200] == r.after for r in got)
    text = "item2 " * 300
    got = sections.stream(docs(spark, text), "id").orderBy("nth").collect()
    assert len(got) == 300 and all(text[r.pos : r.stop] == r.heading and text[max(0, r.pos - 90) : r.pos] == r.before90 and text[r.stop : r.stop + 200] == r.after for r in got)


def test_texts_are_read_once_and_without_python(spark):
    plan = sections.winners(docs(spark, SECTION), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Python" not in plan and "Arrow" not in plan


def test_every_rule_and_reason_occurs(spark):
    d = "/root/testdata/sf0.001"
    from textpanel.plans import registry

    q = registry.queries()
    why = {x for r in q["section_candidates"](spark, d).collect() for x in r.why.split(",")}
    assert why >= {"toc", "xref_after", "xref_before", "quoted", "names_section", "allcaps", "opener", "plausible_len"}
    ends = {r.stop_by for r in q["section_winner"](spark, d).collect()}
    assert ends >= {"1B", "1C", "2", "3", "4", "5", None}
    reasons = {(r.reason or "").split("(")[0] for r in q["section_winner"](spark, d).collect()}
    assert reasons >= {"", "no_item_1a_match", "no_viable_candidate"}
    assert any(r.section_chars and r.section_chars > 500_000 and not r.ok for r in q["section_winner"](spark, d).collect())


def test_suspicious_sections(spark, tmp_path):
    rows = [(i, True, 10_000, "1B", ["opener"], 20, 100) for i in range(7)] + [(10, True, 3_000, "1B", [], 20, 100), (11, True, 26_000, None, ["xref_after"], 20, 100), (12, True, 10_000, "2", [], 9, 49), (13, False, 1, None, [], 0, 0)]
    report = spark.createDataFrame(rows, "id int, ok boolean, section_chars int, stop_by string, why array<string>, n_bold_blocks long, score int")

    def keep(df):
        df.write.parquet(f"{tmp_path}/lengths")
        return spark.read.parquet(f"{tmp_path}/lengths")

    flags = sections.suspicious(report, "id", keep=keep)
    assert {(r.id, r.reason) for r in flags.collect()} == {(10, "much shorter than median"), (11, "much longer than median"), (11, "no terminator found"), (11, "won despite a cross-reference penalty"), (12, "almost no styled headings"), (12, "low confidence score")}
    assert {(r.reason, r.n, tuple(r.members)) for r in sections.by_reason(flags, "id").collect()} >= {("low confidence score", 1, (12,))}


def test_extract_keeps_runs_inside_and_counts_them(spark):
    text = "before " + SECTION + "Item 1B. Unresolved Staff Comments"
    at = text.index("ITEM 1A")
    cells = [(0, 0, "before", True, False, False, 0, 6), (0, 1, "over the edge", True, False, False, 3, at + 4), (0, 2, "x", True, True, False, at, at + 7), (0, 3, "y", False, False, False, at + 8, at + 20), (0, 4, "z", False, False, True, at + 20, len(text))]
    runs = spark.createDataFrame(cells, "id int, idx int, text string, bold boolean, italic boolean, underline boolean, start int, stop int")
    inside, report = sections.extract(docs(spark, text, "nothing"), runs, "id")
    assert sorted((r.idx, r.start, r.stop) for r in inside.collect()) == [(2, 0, 7), (3, 8, 20)]
    got = {r.id: r for r in report.collect()}
    assert got[0].section == SECTION and (got[0].n_blocks, got[0].n_bold_blocks, got[0].n_italic_blocks, got[0].n_styled_blocks) == (2, 1, 1, 1)
    assert not got[1].ok and got[1].section is None and got[1].n_blocks == 0


def test_places_are_looked_for_once_and_are_those_of_the_plain_pattern(spark):
    kept = []
    text = "ITEM 1A. RISK FACTORS We are subject to " + "rain. " * 1500 + "Item 1B. Unresolved Staff Comments None. İtem 2. Properties ıTEM 3 items item1a item 12 item 5market"
    df = docs(spark, text, "nothing", None).withColumn("ok", F.col("text").isNotNull())
    plain = "(?iU)" + "|".join([sections.START, *[p for p, _ in sections.ENDS.values()]])
    found = lambda p: df.select(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("f")).collect()
    assert found(sections.PLACE) == found(plain) and len(found(plain)[0].f) == 5
    runs = spark.createDataFrame([], "id int, idx int, bold boolean, italic boolean, underline boolean, start int, stop int")
    sections.extract(df, runs, "id", keep=lambda x: kept.append(x) or spark.createDataFrame(x.collect(), x.schema))[1].collect()
    assert len(kept) == 1
