"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged alone: does it end like a sentence, is it a row of links, is it boilerplate,
is it mostly symbols or shouting. Lines that fail are removed, and a document that loses too much of its text
with them is rejected. Base statistics of the whole text are reported beside the verdict.

Edge cases: a null or empty text has no words and fails the base rule (fewer than `MIN_WORDS` words); lines
without a word are neither judged nor counted; repeated rows are judged one by one with the same result; other
columns pass through untouched, and columns that the caller already has under an output's name are replaced.
An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import BLANK, WORD, own_name

MIN_WORDS = 50
#: Percent of the words that may stand in repeated three-word windows.
MAX_REPEAT = 50
#: A document goes if the removed lines hold more than this percent of its word characters.
MAX_LOST = 50
SYMBOLS = r"[#*$%&|<>]"
#: What a sentence may end with, closing quotes and brackets after it included.
SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
#: A sentence that ends inside a line: the line is running text although its own end is cut off.
SENTENCE_WITHIN = r"[.!?…。！？][\"'”’»)\]]*[\x20\x09]"
#: What menus and footers say, in English, French, German and Spanish.
MENU = (
    "home|menu|login|log in|sign in|sign up|search|next|previous|back to top|share|read more|contact us|about us"
    "|accueil|connexion|se connecter|s'inscrire|rechercher|suivant|précédent|haut de page|partager|lire la suite|contactez-nous|à propos"
    "|startseite|menü|anmelden|registrieren|suche|suchen|weiter|zurück|nach oben|teilen|weiterlesen|mehr lesen|kontakt|über uns"
    "|inicio|menú|iniciar sesión|registrarse|buscar|siguiente|anterior|volver arriba|compartir|leer más|contacto|contáctenos|sobre nosotros|quiénes somos"
)
#: Phrases of legal notes and site furniture in the same languages, in small letters.
BOILERPLATE = (
    "all rights reserved|privacy policy|terms of use|terms of service|cookie policy|accept cookies|enable javascript|subscribe to our|licensed under|released under|©|lorem ipsum"
    "|tous droits réservés|politique de confidentialité|mentions légales|conditions d'utilisation|accepter les cookies|activer javascript|abonnez-vous"
    "|alle rechte vorbehalten|datenschutzerklärung|impressum|nutzungsbedingungen|cookies akzeptieren|javascript aktivieren|newsletter abonnieren"
    "|todos los derechos reservados|política de privacidad|aviso legal|términos de uso|términos de servicio|aceptar cookies|activar javascript|suscríbete"
)
NAVIGATION = rf"^[\x20\x09-\x0D]*({MENU})([\x20\x09-\x0D]*[|>»/·-]?[\x20\x09-\x0D]*({MENU}))*[\x20\x09-\x0D]*$"
OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lines_removed", "lost_chars", "clean_text", "kept")


def let(value: Column, body) -> Column:
    """`body(value)`, with `value` worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """How many words stand in a three-word window that the list holds twice or more."""

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - v, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeats(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda w, k: (w["w"] == F.get(ordered, k - 1)["w"]) | (w["w"] == F.get(ordered, k + 1)["w"]))
        return let(F.sort_array(F.transform(twice, lambda w: w["i"])), covered)

    def windows(w: Column) -> Column:
        found = F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(
            found,
            lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(
                let(F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("w"), i.alias("i")))), repeats)
            ),
        )

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(words, windows))


def line_fails(line: Column) -> Column:
    """True if a line (with at least one word) is no running text."""
    return let(F.struct(line.alias("line"), F.lower(line).alias("low")), lambda x: fails(x["line"], x["low"]))


def fails(line: Column, low: Column) -> Column:
    bare = F.length(F.regexp_replace(line, f"{BLANK}+", ""))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    return (
        (~line.rlike(SENTENCE_END) & ~line.rlike(SENTENCE_WITHIN))
        | (F.regexp_count(line, F.lit(r"[|>»·]")) * 8 > bare)
        | low.rlike(NAVIGATION)
        | reduce(lambda a, b: a | b, [low.contains(p) for p in BOILERPLATE.split("|")])
        | (symbols * 10 > bare)
        | (line.rlike(r"\p{Lu}{2}") & ~line.rlike(r"\p{Ll}"))
    )


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the base statistics, the cleaned text and the verdict `kept`."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in OUTPUTS])
    body, w, lines, bad = own_name(docs, "q_text", "q_words", "q_lines", "q_failed")
    df = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({w: F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))})
    df = df.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": repeated_words(F.col(w)).cast("long"),
            bad: F.filter(lines, line_fails),
        }
    )
    df = df.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT),
            "lines_removed": F.size(bad).cast("long"),
            "lost_chars": F.length(F.regexp_replace(F.array_join(bad, ""), f"{BLANK}+", "")).cast("long"),
            "clean_text": F.array_join(F.filter(F.split(body, "\n"), lambda x: ~(x.rlike(WORD) & line_fails(x))), "\n"),
        }
    )
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST)
    return df.withColumn("kept", kept).drop(body, w, lines, bad)


def op5_query(spark, sf_dir):
    from textpanel.llm.common import table

    return quality(table(spark, sf_dir, "documents")).select("doc_id", *[c for c in OUTPUTS if c != "clean_text"])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM rep, (VALUES (0), (1), (2)) v(k)) GROUP BY doc_id),
ln AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
bad AS (
  SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS bare,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS sym,
         length(line) - length(regexp_replace(line, '[|>»·]', '', 'g')) AS seps
  FROM ln),
judged AS (
  SELECT doc_id, line, bare,
    (NOT regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$') AND NOT regexp_matches(line, '[.!?…。！？]["''”’»)\]]*[\x20\x09]'))
    OR seps * 8 > bare
    OR regexp_matches(lower(line), '{navigation}')
    OR regexp_matches(lower(line), '{boilerplate}')
    OR sym * 10 > bare
    OR (regexp_matches(line, '\p{Lu}{2}') AND NOT regexp_matches(line, '\p{Ll}')) AS fails
  FROM bad),
by_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN 1 ELSE 0 END) AS removed, sum(CASE WHEN fails THEN bare ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(b.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(b.removed, 0) AS lines_removed, coalesce(b.lost, 0) AS lost_chars
  FROM w LEFT JOIN by_doc b USING (doc_id) LEFT JOIN cov c USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  CAST(lines_removed AS BIGINT) AS lines_removed, CAST(lost_chars AS BIGINT) AS lost_chars,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars * 100 <= word_chars * 50 AS kept
FROM s
""".replace("{navigation}", NAVIGATION.replace("'", "''")).replace("{boilerplate}", BOILERPLATE.replace("'", "''"))
