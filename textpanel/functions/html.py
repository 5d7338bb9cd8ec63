"""Pages to styled runs of text: a page's tags as a stream, the open elements as a fold over it, runs by windows.

Runs come in document order. Unclosed paragraphs, list items and cells end where a new one or a block begins, and what
was opened inside them ends with them, so that an emphasis that nobody closed doesn't reach beyond its paragraph.
Inline tags join their texts; blocks and line breaks separate them. Comments, scripts, styles and titles are passed over.

All of it is column expressions. A page becomes an array of tokens; folding over them gives each token the path of the
elements that are open behind it, such as `/body#3/p#7/b#9/`, whose numbers lead to the tokens that opened them and so to
their styles. Paths are gathered in chunks, since adding to an array copies it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.functions.text import trie_pattern

#: Tags that join their text to what stands around them.
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "em", "font", "i", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SILENT = ("script", "style", "title")
#: Opening one of these ends an open element of the listed kinds first.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements out of which an implied end doesn't reach.
SCOPE = ("table", "td", "th", "ul", "ol", "dl", "body", "html")
#: Sizes in points, and how styles are written.
POINTS = {"pt": 1.0, "px": 0.75, "em": 12.0, "rem": 12.0}
WEIGHT = r"(?i)font-weight\s*:\s*(bold|[6-9]\d\d)"
SLANT = r"(?i)font-style\s*:\s*italic"
LINE = r"(?i)text-decoration[^;]*:[^;]*underline"
SIZE = r"(?i)font-size\s*:\s*([\d.]+)\s*(pt|px|rem|em)"
ALIGN = r"(?i)text-align\s*:\s*(left|right|center|justify)"
WHITE = "[\\s\u00a0\u2000-\u200b\u202f\u205f\u3000]+"
#: What is passed over, tags, tags that a page breaks off in, and text; a `<` that opens no tag is a text of its own.
TOKENS = (
    r"<!--.*?(?:-->|\z)",
    *[rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in SILENT],
    "<[!?][^>]*>",
    r"</?[a-zA-Z](?:[^>\"']+|\"[^\"]*\"|'[^']*')*>",
    "</?[a-zA-Z][^>]*>",
    r"</?[a-zA-Z][^>]*\z",
    "[^<]+",
    "<",
)
TOKEN = "(?is)" + "|".join(TOKENS)
TAG = r"^</?([a-zA-Z][^\s/>]*)"
CSS = r"(?is)\sstyle\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
CHUNK = 128
#: A character that no reference stands for.
APART = "\x01"
#: Numeric references that stand for other characters than their number says, as browsers read them: windows-1252 in its upper controls.
CONTROLS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, however often `then` names it: the value is that of a singleton array."""
    return F.transform(F.array(value), then)[0]


def decoded(text: Column, bare: bool = True) -> Column:
    """Character references to characters: by the public table of names (the longest that fits, some without a semicolon) or by number.

    Without `bare`, a reference that no semicolon ends, as in a text that was cut off, stays as it stands.
    """
    table = html5 if bare else {k: v for k, v in html5.items() if k.endswith(";")}
    end = ";?" if bare else ";"
    pattern = rf"&(?:#[0-9]+{end}|#[xX][0-9a-fA-F]+{end}|{trie_pattern(list(table))})"
    # A map is searched from its beginning, so names are looked for among those of one initial. Each list is one literal.
    initials: dict[str, list[str]] = {}
    for name in sorted(table):
        initials.setdefault(name[0], []).append(name)
    listed = lambda values: F.split(F.lit(APART.join(values)), APART)
    names = F.create_map(*[x for initial, of_it in initials.items() for x in (F.lit(initial), F.map_from_arrays(listed(of_it), listed([table[n] for n in of_it])))])
    controls = F.create_map(*[F.lit(x) for n, value in CONTROLS.items() for x in (n, value)])

    def character(n: Column) -> Column:
        wrong = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        unseen = (n < 0x20) & ~n.isin(9, 10, 12, 13) | (n == 0x7F)
        return F.when(wrong, "\ufffd").when(unseen, "").when(n.between(0x80, 0x9F), F.element_at(controls, n.cast("int"))).otherwise(char)

    def of(ref: Column) -> Column:
        hexadecimal = ref.rlike("^&#[xX]")
        digits = F.ltrim(F.regexp_extract(ref, "^&#[xX]?([0-9a-fA-F]+)", 1), F.lit("0"))
        # More digits than a character's number can have are as good as the highest ones.
        significant = _once(digits, lambda d: F.when(F.length(d) > 8, "99999999").when(d == "", "0").otherwise(d))
        number = _once(significant, lambda s: F.when(hexadecimal, F.conv(s, 16, 10).cast("long")).otherwise(s.try_cast("long")))
        name = F.substring(ref, F.lit(2), F.length(ref))
        return F.when(ref.startswith("&#"), _once(number, character)).otherwise(F.element_at(F.element_at(names, F.left(name, F.lit(1))), name))

    # Whatever begins with `&` and is longer is a reference. `split` would build the pattern anew for each text.
    pieces = F.regexp_extract_all(text, F.lit(rf"{pattern}|[^&]+|&"), F.lit(0))
    joined = F.array_join(F.transform(pieces, lambda x: F.when(x.startswith("&") & (F.length(x) > 1), F.coalesce(of(x), F.lit(""))).otherwise(x)), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _tokens(html: Column) -> Column:
    """Tokens that matter, with what each says by itself."""

    def read(x: Column) -> Column:
        kind = F.when(~x.startswith("<") | (x == "<"), "text").when(x.rlike("(?is)^<(?:[!?]|(?:script|style|title)\\b)") | ~x.endswith(">"), "none").when(x.startswith("</"), "close").otherwise("open")
        tag = F.when(x.startswith("<"), F.lower(F.regexp_extract(x, TAG, 1))).otherwise("")
        css = F.when(x.startswith("<") & F.lower(x).contains("style"), F.concat(*[F.regexp_extract(x, CSS, i) for i in (1, 2, 3)])).otherwise("")
        return F.struct(x.alias("x"), kind.alias("kind"), tag.alias("tag"), css.alias("css"))

    def token(t: Column) -> Column:
        x, tag, css = t["x"], t["tag"], t["css"]
        size = F.regexp_extract(css, SIZE, 1).try_cast("double") * F.element_at(F.create_map(*[F.lit(v) for p in POINTS.items() for v in p]), F.lower(F.regexp_extract(css, SIZE, 2)))
        styled = css != ""
        named = lambda *tags: tag.isin(*tags)
        return F.struct(
            t["kind"].alias("kind"),
            F.when(t["kind"] == "text", x).alias("data"),
            tag.alias("tag"),
            named(*sorted(INLINE)).alias("inline"),
            (named(*sorted(VOID)) | x.endswith("/>")).alias("void"),
            (named("b", "strong") | (styled & css.rlike(WEIGHT))).alias("bold"),
            (named("i", "em") | (styled & css.rlike(SLANT))).alias("italic"),
            (named("u") | (styled & css.rlike(LINE))).alias("underline"),
            F.when(styled, F.bround(size, 1)).alias("font_size"),
            F.when(styled, F.nullif(F.lower(F.regexp_extract(css, ALIGN, 1)), F.lit(""))).alias("align"),
        )

    known = F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), read)
    return F.transform(F.filter(known, lambda t: t["kind"] != "none"), token)


def _ended(path: Column, kinds: tuple[str, ...], within: tuple[str, ...]) -> Column:
    """`path` without the innermost element of these kinds and what is open inside it, unless an element of `within` is open inside."""
    there = reduce(or_, [F.contains(path, F.lit(f"/{k}#")) for k in kinds])
    return F.when(there, F.regexp_replace(path, rf"^(.*/)(?:{'|'.join(kinds)})#\d+/(?:(?!(?:{'|'.join(within)})#)[^/]+/)*$", "$1")).otherwise(path)


def _behind(path: Column, t: Column, i: Column) -> Column:
    """The path of open elements behind token `i`, from that before it."""

    def ended(p: Column) -> Column:
        found = F.when(F.lit(False), p)
        for kinds in dict.fromkeys(ENDS.values()):
            found = found.when(t["tag"].isin(*[k for k, v in ENDS.items() if v == kinds]), _ended(p, kinds, tuple(s for s in SCOPE if s not in kinds)))
        return found.otherwise(p)

    opened = F.when(t["inline"], path).otherwise(_once(_ended(path, ("p",), SCOPE), ended))
    opened = F.concat(opened, F.when(t["void"], "").otherwise(F.concat(t["tag"], F.lit("#"), i.cast("string"), F.lit("/"))))
    mark = F.concat(F.lit("/"), t["tag"], F.lit("#"))
    closed = F.when(F.contains(path, mark), F.left(path, F.length(path) - F.length(F.call_function("substring_index", path, mark, F.lit(-1))) - F.length(t["tag"]) - 1)).otherwise(path)
    return F.when(t["kind"] == "open", opened).when(t["kind"] == "close", closed).otherwise(path)


def _paths(tokens: Column) -> Column:
    """For each token the path of the elements that are open behind it."""
    numbered = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(CHUNK)), lambda c: F.slice(numbered, c + 1, CHUNK))
    none = F.array().cast("array<string>")

    def step(acc: Column, x: Column) -> Column:
        return _once(_behind(acc["path"], x["t"], x["i"]), lambda p: F.struct(p.alias("path"), F.concat(acc["out"], F.array(p)).alias("out")))

    def whole(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, F.struct(acc["path"].alias("path"), none.alias("out")), step)
        return _once(inner,lambda r: F.struct(r["path"].alias("path"), F.concat(acc["outs"], F.array(r["out"])).alias("outs")))

    start = F.struct(F.lit("/").alias("path"), F.array().cast("array<array<string>>").alias("outs"))
    return F.aggregate(chunks, start, whole, lambda acc: F.flatten(acc["outs"]))


def runs(pages: DataFrame, *keys: str, html: str = "html", bare: bool = True) -> DataFrame:
    """One row per run of text: keys, idx, text, bold, italic, underline, font_size, align, start, stop (in characters of the page's text).

    Pages without html or without text have no rows. `bare` is that of `decoded`. Pages are dealt out before they are read, however few their bytes are.
    """
    spark = pages.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = pages.select(*keys, html).repartition(tasks, *keys).select(*keys, _tokens(F.col(html)).alias("tokens")).withColumn("paths", _paths(F.col("tokens")))

    def styled(t: Column, i: Column) -> Column:
        numbers = F.regexp_extract_all(F.get("paths", i), F.lit(r"#(\d+)/"), F.lit(1))

        def of(opens: Column) -> Column:
            any_of = lambda name: F.exists(opens, lambda o: o[name])
            last = lambda name: F.try_element_at(F.filter(F.transform(opens, lambda o: o[name]), lambda v: v.isNotNull()), F.lit(-1))
            return F.struct(t["data"].alias("data"), *[any_of(n).alias(n) for n in ("bold", "italic", "underline")], last("font_size").alias("font_size"), last("align").alias("align"))

        return _once(F.transform(numbers, lambda n: F.get("tokens", n.cast("int"))), of)

    # Texts, and the tags of blocks, which only set texts apart.
    kept = F.filter(F.transform("tokens", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: (x["t"]["kind"] == "text") | ~x["t"]["inline"])
    rows = df.select(*keys, F.posexplode(F.transform(kept, lambda x: F.when(x["t"]["kind"] == "text", styled(x["t"], x["i"])))).alias("nth", "x")).select(*keys, "nth", "x.*")
    rows = rows.withColumn("data", decoded(F.col("data"), bare))
    rows = rows.withColumn("text", F.nullif(F.regexp_replace(F.regexp_replace("data", f"(?U){WHITE}", " "), "^ | $", ""), F.lit("")))
    order = Window.partitionBy(*keys).orderBy("nth")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = F.col("text").isNotNull()
    rows = rows.withColumns({"idx": F.count("text").over(upto) - 1, "loose": F.lag(real & ~F.col("data").rlike(f"(?U){WHITE}$"), 1, False).over(order)})
    apart = real & (F.col("idx") > 0) & (~F.col("loose") | F.col("data").rlike(f"(?U)^{WHITE}"))
    rows = rows.withColumn("stop", F.sum(F.when(real, F.length("text") + apart.cast("int"))).over(upto).cast("int")).where(real)
    return rows.select(*keys, F.col("idx").cast("int").alias("idx"), "text", "bold", "italic", "underline", "font_size", "align", (F.col("stop") - F.length("text")).cast("int").alias("start"), "stop")


def texts(pages: DataFrame, found: DataFrame, *keys: str, html: str = "html") -> DataFrame:
    """(keys, ok, reason, text): the text of each page from its runs, empty without any; a page without html keeps its row with a reason."""
    before = F.lag("stop").over(Window.partitionBy(*keys).orderBy("idx"))
    parts = found.withColumn("part", F.concat(F.when(F.col("start") > before, " ").otherwise(""), "text"))
    joined = parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "part"))), lambda x: x["part"]), "").alias("text"))
    there = F.col(html).isNotNull()
    out = pages.select(*keys, there.alias("ok"), F.when(~there, "file_missing").alias("reason")).join(joined, list(keys), "left")
    return out.withColumn("text", F.when(F.col("ok"), F.coalesce("text", F.lit(""))))
