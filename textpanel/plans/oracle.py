"""The named queries' results, stated in SQL over the driver's tables, as a check on the Spark plans."""

from __future__ import annotations

import re

from textpanel.constants import BANDS, HEADER_REPEATS, KEYWORDS, MAX_CATEGORY, MAX_HEADING, MAX_SECTION, MIN_BODY, MIN_SECTION, SUMMARY_SHARE
from textpanel.functions import html
from textpanel.operators import sections, splitting
from textpanel.operators.faults import FAULTS
from textpanel.plans.records import BARE, FILLED, FILLED_TO, LONG, LONG_EVERY, LONG_TO, SHORT, SHORT_TO, SKELETONS, TERM_SENTENCES, TERMS, THEMES, WIDE_THEME

#: The beginning of a word without looking back.
EDGE = "(^|[^a-z0-9_])"


def _hits(text: str, terms: list[str]) -> str:
    return " + ".join(f"len(regexp_extract_all(lower(coalesce({text}, '')), '{EDGE}{t}'))" for t in terms)


def _categories(expr: str, whens: dict[str, str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in whens.items()) + " END"


CTE: dict[str, str] = {
    "adapted": """SELECT doc_id, CAST(substr(source, 4, 9) AS INT) AS cik, source AS ticker, 'Company ' || source AS company_name, CAST(2021 + (doc_id // 20) % 5 AS INT) AS fiscal_year,
        CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS heading,
        CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS body,
        n_chars AS chars, md5(text) AS sign, lang, CASE WHEN doc_id % 4 = 0 THEN '' ELSE ' ' || lang || ' ' END AS filer_category FROM documents""",
    "numbered": "SELECT *, CAST(row_number() OVER (PARTITION BY cik, fiscal_year ORDER BY doc_id NULLS FIRST, sign NULLS FIRST) - 1 AS INT) AS risk_index FROM adapted",
    "records": "SELECT *, ticker || '_FY' || fiscal_year || '_' || lpad(CAST(risk_index AS VARCHAR), CAST(greatest(3, length(CAST(risk_index AS VARCHAR))) AS INT), '0') AS risk_id FROM numbered",
    "words": "SELECT risk_id, cik, fiscal_year, 'heading' AS field, regexp_extract_all(lower(heading), '[a-z]+') AS w FROM records UNION ALL SELECT risk_id, cik, fiscal_year, 'body' AS field, regexp_extract_all(lower(body), '[a-z]+') AS w FROM records",
    "grams": "SELECT risk_id, cik, fiscal_year, field, unnest(w) AS term FROM words UNION ALL SELECT risk_id, cik, fiscal_year, field, w[i] || '_' || w[i + 1] AS term FROM (SELECT *, unnest(range(1, len(w))) AS i FROM words WHERE len(w) >= 2)",
    "counts": "SELECT risk_id, cik, fiscal_year, field, term, count(*) AS tf FROM grams GROUP BY ALL",
    "dfs": "SELECT field, term, count(*) AS df FROM counts GROUP BY field, term",
    "weighted": "SELECT c.risk_id, c.cik, c.fiscal_year, c.field, c.term, d.df, (1 + ln(c.tf)) * (ln(((SELECT count(*) FROM records) + 1) / (d.df + 1)) + 1) AS w FROM counts c JOIN dfs d ON c.field = d.field AND c.term = d.term",
    "norms": "SELECT risk_id, field, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY risk_id, field",
    "unit": "SELECT t.risk_id, t.cik, t.fiscal_year, t.field, t.term, t.w / n.norm AS w FROM weighted t JOIN norms n ON t.risk_id = n.risk_id AND t.field = n.field WHERE t.df > 1",
    "edges": "SELECT * FROM (SELECT a.cik, a.fiscal_year, a.risk_id AS curr_id, b.risk_id AS prev_id, sum(CASE a.field WHEN 'heading' THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END * a.w * b.w) AS sim FROM unit a JOIN unit b ON a.cik = b.cik AND a.fiscal_year = b.fiscal_year + 1 AND a.field = b.field AND a.term = b.term GROUP BY ALL) WHERE sim > 0.03",
    "rounds": """SELECT 0 AS k, 'open' AS kind, cik, fiscal_year, curr_id, prev_id, sim FROM edges
        UNION ALL SELECT * FROM (
            WITH placed AS MATERIALIZED (SELECT *, row_number() OVER c AS curr_rank, coalesce(lead(sim) OVER c, 0) AS curr_next, row_number() OVER p AS prev_rank, coalesce(lead(sim) OVER p, 0) AS prev_next FROM rounds WHERE kind = 'open'
                WINDOW c AS (PARTITION BY curr_id ORDER BY sim DESC, prev_id DESC), p AS (PARTITION BY prev_id ORDER BY sim DESC, curr_id DESC)),
            taken AS MATERIALIZED (SELECT * FROM placed WHERE curr_rank = 1 AND prev_rank = 1 AND sim >= 0.25 AND sim - curr_next >= 0.05 AND sim - prev_next >= 0.05)
            SELECT k + 1, 'pair', cik, fiscal_year, curr_id, prev_id, sim FROM taken
            UNION ALL SELECT k + 1, 'open', cik, fiscal_year, curr_id, prev_id, sim FROM placed WHERE EXISTS (SELECT 1 FROM taken) AND curr_id NOT IN (SELECT curr_id FROM taken) AND prev_id NOT IN (SELECT prev_id FROM taken)) step""",
    "pairs": "SELECT cik, fiscal_year, curr_id, prev_id, sim, k FROM rounds WHERE kind = 'pair'",
    "rest": "SELECT * FROM rounds WHERE kind = 'open' AND k = (SELECT max(k) FROM rounds)",
    "years": "SELECT DISTINCT cik, fiscal_year FROM records",
    "compared": "SELECT a.cik, a.fiscal_year FROM years a JOIN years b ON a.cik = b.cik AND a.fiscal_year = b.fiscal_year + 1",
    "best_curr": "SELECT curr_id, max(struct_pack(s := sim, o := prev_id)) AS best FROM rest GROUP BY curr_id",
    "best_prev": "SELECT prev_id, max(struct_pack(s := sim, o := curr_id)) AS best FROM rest GROUP BY prev_id",
    "unlabelled": """SELECT cik, fiscal_year, curr_id, prev_id, sim, false AS ambiguous, NULL AS rejected_id FROM pairs
        UNION ALL SELECT r.cik, r.fiscal_year, r.risk_id, NULL, coalesce(b.best.s, 0), coalesce(b.best.s, 0) >= 0.25, b.best.o FROM records r JOIN compared c ON c.cik = r.cik AND c.fiscal_year = r.fiscal_year LEFT JOIN best_curr b ON b.curr_id = r.risk_id WHERE r.risk_id NOT IN (SELECT curr_id FROM pairs)
        UNION ALL SELECT r.cik, r.fiscal_year + 1, NULL, r.risk_id, coalesce(b.best.s, 0), coalesce(b.best.s, 0) >= 0.25, b.best.o FROM records r JOIN compared c ON c.cik = r.cik AND c.fiscal_year = r.fiscal_year + 1 LEFT JOIN best_prev b ON b.prev_id = r.risk_id WHERE r.risk_id NOT IN (SELECT prev_id FROM pairs)""",
    "labelled": "SELECT cik, CAST(fiscal_year AS INT) AS fiscal_year, curr_id, prev_id, rejected_id, round(sim, 4) AS similarity, ambiguous, CASE WHEN ambiguous THEN 'AMBIGUOUS' WHEN prev_id IS NULL THEN 'NEW' WHEN curr_id IS NULL THEN 'DROPPED' WHEN round(sim, 4) >= 0.9 THEN 'CARRIED_FORWARD' ELSE 'MATERIALLY_REVISED' END AS label, CASE WHEN (round(sim, 4) >= 0.2 AND round(sim, 4) < 0.4) OR ambiguous THEN 'y' ELSE '' END AS review FROM unlabelled",
    "totals": "SELECT cik, fiscal_year, count(*) * (1 + abs(any_value(fiscal_year) % 2)) AS risks, sum(chars) AS chars FROM records GROUP BY ALL",
    "churn": "SELECT cik, fiscal_year, sum(CASE WHEN label IN ('NEW', 'DROPPED') THEN 1 ELSE 0 END) / count(*) AS churn FROM labelled GROUP BY ALL",
    "rewrites": "SELECT h.cik, h.fiscal_year, round(h.churn, 3) AS churn, round(n.chars / p.chars, 3) AS length_ratio, round(n.risks / p.risks, 3) AS count_ratio, p.risks AS n_prev, n.risks AS n_curr FROM churn h JOIN totals n ON n.cik = h.cik AND n.fiscal_year = h.fiscal_year JOIN totals p ON p.cik = h.cik AND p.fiscal_year + 1 = h.fiscal_year WHERE p.chars > 0 AND h.churn >= 0.55 AND abs(n.chars / p.chars - 1) <= 0.35 AND abs(n.risks / p.risks - 1) >= 0.25",
    "matches": "SELECT l.*, r.ticker, substr(r.heading, 1, 300) AS heading FROM labelled l JOIN records r ON r.risk_id = coalesce(l.curr_id, l.prev_id)",
    "scores": "SELECT risk_id, doc_id, " + ", ".join(f"CAST(3 * ({_hits('heading', t)}) + ({_hits('body', t)}) AS BIGINT) AS score_{c}" for c, t in TERMS.items()) + " FROM records",
    "baseline": "SELECT *, CASE greatest(score_financial, score_operational, score_regulatory, score_strategic) WHEN score_financial THEN 'financial' WHEN score_operational THEN 'operational' WHEN score_regulatory THEN 'regulatory' ELSE 'strategic' END AS category, list_sort([score_financial, score_operational, score_regulatory, score_strategic])[4] - list_sort([score_financial, score_operational, score_regulatory, score_strategic])[3] AS margin FROM scores",
    "model": "SELECT risk_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE CASE (doc_id // 3) % 4 WHEN 0 THEN 'financial' WHEN 1 THEN 'operational' WHEN 2 THEN 'regulatory' ELSE 'strategic' END END AS category FROM records WHERE doc_id % 3 = 0 UNION ALL SELECT 'ghost_FY2021_000', 'strategic'",
    "gold": "SELECT r.risk_id, r.doc_id, CASE WHEN l.quality = 1 THEN CASE WHEN l.toxic = 1 THEN 'regulatory' ELSE 'financial' END ELSE CASE WHEN l.toxic = 1 THEN 'strategic' ELSE 'operational' END END AS category FROM labels l JOIN records r ON r.doc_id = l.doc_id",
    "dups": "SELECT risk_id FROM (SELECT risk_id, row_number() OVER (PARTITION BY cik, fiscal_year, heading ORDER BY risk_index) AS nth FROM records) WHERE nth > 1",
    "record_quarantine": """SELECT 'raw_risk_factor' AS source_table, risk_id AS record_id, 'excluded_company' AS reason, ticker || ' is excluded from the panel' AS detail FROM records WHERE cik = 7
        UNION ALL SELECT 'raw_risk_factor', risk_id, 'empty_heading', 'heading is blank or shorter than 10 characters' FROM records WHERE heading IS NULL OR length(trim(heading)) < 10
        UNION ALL SELECT 'raw_risk_factor', risk_id, 'short_body', 'body is shorter than 200 characters' FROM records WHERE length(body) < 200
        UNION ALL SELECT 'raw_risk_factor', risk_id, 'duplicate_heading_in_filing', 'the filing has an earlier record with this heading' FROM dups""",
    "clean": "SELECT risk_id, doc_id, cik, ticker, company_name, fiscal_year, risk_index, nullif(trim(filer_category), '') AS filer_category, trim(heading) AS heading, body, chars, cik = 3 AS company_has_caveat FROM records WHERE risk_id NOT IN (SELECT record_id FROM record_quarantine)",
    "quarantine": "SELECT * FROM record_quarantine UNION ALL SELECT 'raw_yoy_match', curr_id, 'prior_risk_quarantined', 'matched with ' || prev_id || ', which is quarantined' FROM matches WHERE prev_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM clean c WHERE c.risk_id = prev_id)",
    "clean_match": "SELECT curr_id AS risk_id, CASE WHEN EXISTS (SELECT 1 FROM clean c WHERE c.risk_id = prev_id) THEN prev_id END AS prior_risk_id, cik, ticker, fiscal_year, similarity, label AS yoy_label, nullif(review, '') = 'y' AS flagged_for_review, prev_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM clean c WHERE c.risk_id = prev_id) AS prior_risk_missing FROM matches",
    "clean_category": "SELECT coalesce(m.risk_id, b.risk_id) AS risk_id, coalesce(nullif(m.category, ''), b.category) AS category, CASE WHEN nullif(m.category, '') IS NOT NULL THEN 'llm' ELSE 'keywords' END AS classifier FROM baseline b FULL OUTER JOIN model m ON b.risk_id = m.risk_id",
    "dim_company": "SELECT DISTINCT cik, ticker, company_name, company_has_caveat FROM clean",
    "mart": "SELECT r.risk_id, r.cik, r.ticker, r.company_name, r.fiscal_year, r.risk_index, r.heading, r.chars, r.filer_category, r.company_has_caveat, c.category, c.classifier AS category_classifier, m.yoy_label, m.similarity, m.prior_risk_id, m.flagged_for_review, coalesce(m.prior_risk_missing, false) AS prior_risk_missing, g.category AS gold_category, g.category IS NOT NULL AS in_gold_set FROM clean r LEFT JOIN clean_category c ON c.risk_id = r.risk_id LEFT JOIN clean_match m ON m.risk_id = r.risk_id LEFT JOIN gold g ON g.risk_id = r.risk_id",
    "gone": "SELECT m.prior_risk_id AS risk_id, m.cik, m.ticker, m.fiscal_year AS dropped_in_fiscal_year, r.heading, r.fiscal_year AS last_disclosed_fiscal_year FROM clean_match m JOIN clean r ON r.risk_id = m.prior_risk_id WHERE m.yoy_label = 'DROPPED'",
    "judged": "SELECT g.risk_id, g.category AS truth, b.category AS predicted FROM gold g JOIN baseline b ON b.risk_id = g.risk_id",
    "judged_model": "SELECT g.risk_id, g.category AS truth, m.category AS predicted FROM gold g JOIN (SELECT * FROM model WHERE category <> '') m ON m.risk_id = g.risk_id",
}


def _per_class(judged: str) -> str:
    return f"""SELECT class, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, tp + fn AS support,
        CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) ELSE 0 END AS f1
        FROM (SELECT class, count(*) FILTER (WHERE side = 't' AND hit) AS tp, count(*) FILTER (WHERE side = 'p' AND NOT hit) AS fp, count(*) FILTER (WHERE side = 't' AND NOT hit) AS fn
              FROM (SELECT truth AS class, 't' AS side, truth = predicted AS hit FROM {judged} UNION ALL SELECT predicted, 'p', truth = predicted FROM {judged}) GROUP BY class)"""


CTE["per_class"] = _per_class("judged")
CTE["per_class_model"] = _per_class("judged_model")


def sql(select: str) -> str:
    """`select` with the named results that it needs, in their order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name in set(re.findall(r"\b[a-z_]+\d*\b", text)) & CTE.keys() - needed:
            needed.add(name)
            todo.append(CTE[name])
    return "WITH RECURSIVE " + ",\n".join(f"{k} AS ({v})" for k, v in CTE.items() if k in needed) + "\n" + select if needed else select


def pct(a: str, b: str, digits: int = 1) -> str:
    return f"round(100.0::DOUBLE * {a} / {b}, {digits})"


def wilson(k: str, n: str) -> tuple[str, str]:
    z = "1.96::DOUBLE"
    p = f"({k} / {n})"
    mid, half = f"(({p} + {z} * {z} / (2 * {n})) / (1 + {z} * {z} / {n}))", f"({z} * sqrt({p} * (1 - {p}) / {n} + {z} * {z} / (4 * {n} * {n})) / (1 + {z} * {z} / {n}))"
    return f"greatest(0.0::DOUBLE, {mid} - {half})", f"least(1.0::DOUBLE, {mid} + {half})"


LOW, HIGH = wilson("firms", "panel")
ALOW, AHIGH = wilson("hits", "n")
_share = lambda c: pct(f"sum(CASE WHEN category = '{c}' THEN 1 ELSE 0 END)", "count(*)")
_isl = lambda *x: "CAST(sum(CASE WHEN yoy_label IN (" + ", ".join(f"'{i}'" for i in x) + ") THEN 1 ELSE 0 END) AS BIGINT)"
_themes = ", ".join(f"('{t}', '{p}')" for t, p in THEMES.items())
SHAPE = r"CASE WHEN regexp_matches(t, '^\d{1,4}$') THEN 'page_number' WHEN regexp_matches(t, '(?i)^(table of contents|index|part\s+[ivx]+|form\s+10-k|annual report|glossary|back to contents)\b') THEN 'furniture' WHEN length(t) < 4 THEN 'tiny' WHEN upper(t) = t AND lower(t) <> t THEN 'ALL_CAPS' WHEN length(t) > 400 THEN 'long_paragraph' WHEN regexp_matches(t, '[.?!]$') THEN 'sentence_heading' ELSE 'short_phrase' END"
PLAIN = r"""regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script)[^>]*>.*?</script>', ' ', 'g'), '(?is)<(style)[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&#160;', ' '), '[ \t\n\r\f\x0b\x{a0}]+', ' ', 'g')"""
_cnt = lambda p, t="html": f"CAST(len(regexp_extract_all({t}, '{p}')) AS INT)"

SQL: dict[str, str] = {
    "raw_scan_typed": "SELECT doc_id, cik, ticker, fiscal_year, risk_index, risk_id, length(heading) AS heading_chars, length(body) AS body_chars FROM records",
    "quarantine_rows": "SELECT source_table, record_id, reason, detail FROM quarantine",
    "quarantine_by_reason": "SELECT source_table, reason, count(*) AS records FROM quarantine GROUP BY ALL",
    "clean_records": "SELECT risk_id, cik, fiscal_year, risk_index, filer_category, heading, chars, company_has_caveat FROM clean",
    "clean_matches": "SELECT risk_id, prior_risk_id, cik, ticker, fiscal_year, similarity, yoy_label, flagged_for_review, prior_risk_missing FROM clean_match",
    "clean_category_full_outer": "SELECT risk_id, category, classifier FROM clean_category",
    "dim_company": "SELECT cik, ticker, company_name, company_has_caveat FROM dim_company",
    "dim_year": "SELECT DISTINCT fiscal_year, fiscal_year >= 2023 AS post_event, fiscal_year || '-12-31' AS period_end FROM clean",
    "dim_category": "SELECT DISTINCT category, CASE category WHEN 'financial' THEN 'Money: credit, funding, rates, securities' WHEN 'operational' THEN 'Things breaking: cyber, systems, vendors, people' WHEN 'regulatory' THEN 'Rules and courts: laws, supervisors, litigation' WHEN 'strategic' THEN 'The plan failing: competition, M&A, reputation' END AS description FROM clean_category WHERE category IS NOT NULL",
    "mart_fact": "SELECT risk_id, cik, ticker, fiscal_year, risk_index, heading, chars, filer_category, company_has_caveat, category, category_classifier, yoy_label, similarity, prior_risk_id, flagged_for_review, prior_risk_missing, gold_category, in_gold_set FROM mart",
    "mart_dropped": "SELECT risk_id, cik, ticker, dropped_in_fiscal_year, heading, last_disclosed_fiscal_year FROM gone",
    "integrity_checks": "SELECT 'orphan prior_risk_id' AS \"check\", count(*) AS n FROM mart m WHERE prior_risk_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM clean c WHERE c.risk_id = m.prior_risk_id) UNION ALL SELECT 'match with a quarantined prior risk', count(*) FROM mart WHERE prior_risk_missing UNION ALL SELECT 'duplicate risk_id', count(*) FROM (SELECT risk_id FROM mart GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'excluded company leaked in', count(*) FROM mart WHERE cik = 7 UNION ALL SELECT 'NEW with a prior risk attached', count(*) FROM mart WHERE yoy_label = 'NEW' AND prior_risk_id IS NOT NULL",
    "quality_scalars": "SELECT count(DISTINCT cik) AS companies, count(DISTINCT fiscal_year) AS fiscal_years, count(*) AS risk_factors, count(*) FILTER (WHERE category IS NULL) AS missing_category, count(*) FILTER (WHERE yoy_label IS NULL) AS missing_yoy_label, count(*) FILTER (WHERE flagged_for_review) AS flagged_for_review, count(*) FILTER (WHERE company_has_caveat) AS from_caveat_companies, count(*) FILTER (WHERE in_gold_set) AS in_gold_set, (SELECT count(*) FROM quarantine) AS quarantined FROM mart",
    "completeness_by_year": "SELECT fiscal_year, count(*) AS risks, count(category) AS categorised, count(yoy_label) AS matched FROM mart GROUP BY fiscal_year",
    "classifier_coverage": "SELECT coalesce(category_classifier, '(none)') AS classifier, count(*) AS n FROM mart GROUP BY 1",
    "headline_by_year": f"SELECT fiscal_year, count(DISTINCT cik) AS companies, {pct('count(DISTINCT cik)', '(SELECT count(*) FROM dim_company)')} AS pct_of_panel, count(*) AS risk_factors FROM mart WHERE yoy_label = 'NEW' AND regexp_matches(lower(heading), '{WIDE_THEME}') GROUP BY fiscal_year",
    "theme_control": f"SELECT t.theme, " + ", ".join(f"count(DISTINCT CASE WHEN m.fiscal_year = {y} THEN m.cik END) AS fy{y}" for y in (2022, 2023, 2024, 2025)) + f" FROM (VALUES {_themes}) t(theme, pattern) LEFT JOIN mart m ON m.yoy_label = 'NEW' AND regexp_matches(lower(m.heading), t.pattern) GROUP BY t.theme",
    "first_movers": f"SELECT first_year, count(*) AS starting, CAST(sum(count(*)) OVER (ORDER BY first_year) AS BIGINT) AS cumulative, string_agg(ticker, ', ' ORDER BY ticker) AS which FROM (SELECT cik, ticker, min(fiscal_year) AS first_year FROM mart WHERE regexp_matches(lower(heading), '{THEMES['deposits']}') GROUP BY cik, ticker) GROUP BY first_year",
    "churn_by_company": f"SELECT ticker, fiscal_year, count(*) AS risks, {_isl('NEW')} AS new_risks, {_isl('MATERIALLY_REVISED')} AS revised, {_isl('CARRIED_FORWARD')} AS unchanged, {pct(_isl('NEW', 'MATERIALLY_REVISED'), 'count(*)')} AS pct_changed FROM mart WHERE yoy_label IS NOT NULL GROUP BY ticker, fiscal_year HAVING count(*) > 7 ORDER BY pct_changed DESC, ticker, fiscal_year LIMIT 20",
    "category_mix": f"SELECT fiscal_year, {_share('financial')} AS financial, {_share('operational')} AS operational, {_share('regulatory')} AS regulatory, {_share('strategic')} AS strategic, count(*) AS total FROM mart WHERE category IS NOT NULL GROUP BY fiscal_year",
    "company_vs_peers": f"SELECT p.category, coalesce(o.risks, 0) AS own_risk_factors, p.peers_disclosing, {pct('p.peers_disclosing', '(SELECT count(*) FROM dim_company)')} AS pct_of_peers FROM (SELECT category, count(DISTINCT cik) AS peers_disclosing FROM mart WHERE fiscal_year = 2025 AND category IS NOT NULL GROUP BY 1) p LEFT JOIN (SELECT category, count(*) AS risks FROM mart WHERE fiscal_year = 2025 AND ticker = 'src5' AND category IS NOT NULL GROUP BY 1) o ON o.category = p.category",
    "template_propagation": "SELECT substr(heading, 1, 90) AS heading_start, count(DISTINCT cik) AS companies, string_agg(DISTINCT ticker, ', ' ORDER BY ticker) AS which, min(fiscal_year) AS first_seen FROM mart GROUP BY 1 HAVING count(DISTINCT cik) >= 3 ORDER BY companies DESC, heading_start LIMIT 15",
    "data_quality": f"SELECT reason, count(*) AS records, {pct('count(*)', '(SELECT count(*) FROM records)', 2)} AS pct_of_raw FROM quarantine GROUP BY reason",
    "gold_agreement": "SELECT gold_category AS truth, category AS predicted, count(*) AS n FROM mart WHERE in_gold_set AND category IS NOT NULL GROUP BY 1, 2",
    "what_disappeared": "SELECT dropped_in_fiscal_year, ticker, substr(heading, 1, 100) AS stopped_disclosing, risk_id FROM gone ORDER BY dropped_in_fiscal_year DESC, ticker, risk_id LIMIT 25",
    "theme_signal_by_year": "SELECT y.fiscal_year, " + ", ".join(f"count(*) FILTER (WHERE m.label = '{x}') AS \"{x}\"" for x in ("NEW", "CARRIED_FORWARD", "MATERIALLY_REVISED", "DROPPED", "AMBIGUOUS")) + f" FROM (SELECT DISTINCT fiscal_year FROM matches) y LEFT JOIN matches m ON m.fiscal_year = y.fiscal_year AND regexp_matches(m.heading, '(?i){WIDE_THEME}') GROUP BY 1",
    "theme_signal_wilson": f"SELECT fiscal_year, firms, panel, {pct('firms', 'panel')} AS pct, round(100 * {LOW}, 1) AS low, round(100 * {HIGH}, 1) AS high FROM (SELECT fiscal_year, count(DISTINCT CASE WHEN label = 'NEW' AND regexp_matches(heading, '(?i){WIDE_THEME}') THEN ticker END) AS firms, (SELECT count(DISTINCT cik) FROM matches) AS panel FROM matches GROUP BY fiscal_year)",
    "theme_signal_peak": f"SELECT fiscal_year, count(DISTINCT ticker) AS firms, string_agg(DISTINCT ticker, ', ' ORDER BY ticker) AS which FROM matches WHERE label = 'NEW' AND regexp_matches(heading, '(?i){WIDE_THEME}') GROUP BY fiscal_year ORDER BY firms DESC, fiscal_year LIMIT 1",
    "theme_share_by_year": f"SELECT y.fiscal_year, t.theme, {pct('count(DISTINCT m.cik)', '(SELECT count(DISTINCT cik) FROM records)')} AS pct FROM (SELECT DISTINCT fiscal_year FROM records WHERE fiscal_year > (SELECT min(fiscal_year) FROM records)) y CROSS JOIN (VALUES {_themes}) t(theme, pattern) LEFT JOIN matches m ON m.label = 'NEW' AND m.curr_id IS NOT NULL AND m.fiscal_year = y.fiscal_year AND regexp_matches(substr(m.heading, 1, 240), '(?i)' || t.pattern) GROUP BY y.fiscal_year, t.theme",
    "app_extract": "SELECT r.risk_id, r.cik, r.ticker, r.fiscal_year, substr(r.heading, 1, 240) AS heading, r.chars, r.cik = 3 AS caveat, coalesce(m.label, '') AS yoy_label, m.similarity, coalesce(m.review, '') AS review, coalesce(c.category, '') AS category, coalesce(c.classifier, '') AS category_source FROM records r LEFT JOIN (SELECT * FROM matches WHERE curr_id IS NOT NULL) m ON m.curr_id = r.risk_id LEFT JOIN clean_category c ON c.risk_id = r.risk_id UNION ALL SELECT r.risk_id, r.cik, r.ticker, m.fiscal_year, substr(r.heading, 1, 240), 0, r.cik = 3, m.label, m.similarity, m.review, '', '' FROM matches m JOIN records r ON r.risk_id = m.prev_id WHERE m.label = 'DROPPED'",
    "keyword_scores": "SELECT doc_id, score_financial, score_operational, score_regulatory, score_strategic FROM scores",
    "keyword_category": "SELECT doc_id, category, CAST(margin AS BIGINT) AS margin FROM baseline",
    "category_frequencies": f"SELECT category, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM baseline)')} AS share FROM baseline GROUP BY category",
    "token_stats": "SELECT field, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens, max(tf) AS max_tf FROM counts GROUP BY field",
    "doc_freq": "SELECT field, term, df FROM dfs",
    "tfidf_norms": "SELECT risk_id, field, round(norm, 4) AS norm FROM norms",
    "similarity_edges": "SELECT curr_id, prev_id, round(sim, 4) AS sim FROM edges",
    "match_round1": "SELECT curr_id, prev_id, round(sim, 4) AS sim FROM pairs WHERE k = 1",
    "yoy_labels": "SELECT cik, fiscal_year, curr_id, prev_id, similarity, label, review FROM labelled",
    "yoy_by_year": "SELECT fiscal_year, label, count(*) AS n FROM labelled GROUP BY ALL",
    "structural_rewrite": "SELECT * FROM rewrites",
    "similarity_histogram": "SELECT band, count(sim) AS n FROM (VALUES " + ", ".join(f"('{a:.2f}-{b:.2f}', {a}::DOUBLE, {b}::DOUBLE)" for a, b in ((0.0, 0.2), (0.2, 0.35), (0.35, 0.5), (0.5, 0.65), (0.65, 0.8), (0.8, 0.9), (0.9, 0.95), (0.95, 1.01))) + ") g(band, lo, hi) LEFT JOIN (SELECT round(sim, 4) AS sim FROM edges) e ON e.sim >= g.lo AND e.sim < g.hi GROUP BY band",
    "similarity_percentiles": "SELECT CAST(q AS INT) AS percentile, v AS value FROM (VALUES (5), (10), (25), (50), (75), (90), (95), (99)) p(q) JOIN (SELECT round(sim, 4) AS v, row_number() OVER (ORDER BY round(sim, 4)) - 1 AS place, count(*) OVER () AS n FROM edges) s ON s.place = floor(n * q / 100)",
    "verify_new_topn": f"SELECT curr_id, prev_id, round(sim, 4) AS sim, CAST(rank AS INT) AS rank, sim >= 0.25 AS above_minimum FROM (SELECT t.curr_id, p.risk_id AS prev_id, coalesce(e.sim, 0) AS sim, row_number() OVER (PARTITION BY t.curr_id ORDER BY coalesce(e.sim, 0) DESC, p.heading, p.risk_id) AS rank FROM matches t LEFT JOIN records p ON p.cik = t.cik AND p.fiscal_year = 2022 LEFT JOIN edges e ON e.curr_id = t.curr_id AND e.prev_id = p.risk_id WHERE t.label = 'NEW' AND t.fiscal_year = 2023 AND regexp_matches(t.heading, '(?i){WIDE_THEME}')) WHERE rank <= 5",
    "confusion_matrix": "SELECT a.c AS truth, b.c AS predicted, count(j.risk_id) AS n FROM (SELECT truth AS c FROM judged UNION SELECT predicted FROM judged) a CROSS JOIN (SELECT truth AS c FROM judged UNION SELECT predicted FROM judged) b LEFT JOIN judged j ON j.truth = a.c AND j.predicted = b.c GROUP BY a.c, b.c",
    "classification_report": "SELECT class, tp, fp, fn, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM per_class",
    "macro_f1": f"SELECT n, round(hits / n, 6) AS accuracy, round({ALOW}, 6) AS low, round({AHIGH}, 6) AS high, round((SELECT avg(f1) FROM per_class), 6) AS macro_f1, round((SELECT max(c) FROM (SELECT count(*) AS c FROM judged GROUP BY truth)) / n, 6) AS majority_floor FROM (SELECT count(*) AS n, count(*) FILTER (WHERE truth = predicted) AS hits FROM judged)",
    "compare_systems": "SELECT coalesce(a.class, b.class) AS class, round(coalesce(a.f1, 0), 6) AS f1_a, round(coalesce(b.f1, 0), 6) AS f1_b, coalesce(b.f1, 0) > coalesce(a.f1, 0) AS b_wins FROM per_class a FULL OUTER JOIN per_class_model b ON a.class = b.class",
    "self_agreement": "SELECT count(*) AS n, count(*) FILTER (WHERE b.category = m.category) AS agree, round(count(*) FILTER (WHERE b.category = m.category) / count(*), 6) AS rate FROM baseline b JOIN model m ON m.risk_id = b.risk_id WHERE m.category <> ''",
    "strat_sample": "SELECT risk_id, cik, fiscal_year FROM (SELECT risk_id, cik, fiscal_year, row_number() OVER (PARTITION BY cik, fiscal_year ORDER BY md5(risk_id || '20240601'), risk_id) AS nth FROM records) ORDER BY nth, md5(concat_ws('|', cik, fiscal_year) || '20240601'), risk_id LIMIT 300",
    "simple_sample": "SELECT risk_id FROM records ORDER BY md5(risk_id || '20240601'), risk_id LIMIT 50",
    "page_text": f"SELECT page_id, md5({PLAIN}) AS text_md5, length({PLAIN}) AS chars_text FROM pages",
    "page_profile": f"SELECT page_id, length(html) AS chars_html, {_cnt('(?i)<table[\\s>]')} AS n_tables, {_cnt('(?i)<h[1-6][\\s>]')} AS n_headings, {_cnt('(?i)<(b|strong)[\\s>]')} AS n_bold, regexp_matches(html, '(?i)<ix:|xmlns:ix=') AS inline_xbrl, round(1 - length({PLAIN}) / greatest(length(html), 1), 3) AS markup_ratio FROM pages",
    "heading_shapes": f"SELECT shape, count(*) AS n FROM (SELECT {SHAPE} AS shape FROM (SELECT heading AS t FROM records)) GROUP BY shape",
    "filing_cohort": """SELECT c_custkey AS cik, val, size_rank FROM (SELECT c_custkey, val, row_number() OVER (ORDER BY val DESC, c_custkey) AS size_rank FROM (SELECT o_custkey AS c_custkey, max(o_totalprice) AS val, count(DISTINCT year(o_orderdate)) AS years FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY o_custkey) WHERE years = 4 AND val BETWEEN 300000 AND 480000) WHERE size_rank <= 55""",
    "name_normalised": r"SELECT s_suppkey, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(upper(s_name || CASE s_suppkey % 4 WHEN 0 THEN ' CORP INC' WHEN 1 THEN '/MD/' WHEN 2 THEN ', N.A. Holding Co' ELSE '' END), '(/[A-Z]{2,4}/?\s*)+$', ''), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), '( (NATIONAL ASSOCIATION|INCORPORATED|CORPORATION|COMPANY|HOLDINGS|HOLDING|CORP|INC|LLC|LTD|CO|NA|ET AL))+$', '') AS name_key FROM supplier",
    "fiscal_years": "SELECT CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS fiscal_year, count(*) AS n FROM orders GROUP BY 1",
    "first_seen_running_total": f"SELECT first_year, count(*) AS starting, CAST(sum(count(*)) OVER (ORDER BY first_year) AS BIGINT) AS cumulative FROM (SELECT cik, min(fiscal_year) AS first_year FROM mart WHERE regexp_matches(lower(heading), '{WIDE_THEME}') GROUP BY cik) GROUP BY first_year",
    "year_coverage": "SELECT c.cik, coalesce(string_agg(CAST(CASE WHEN h.cik IS NULL THEN y.y END AS VARCHAR), ',' ORDER BY y.y), '') AS missing, count(h.cik) = count(*) AS complete FROM (SELECT DISTINCT o_custkey AS cik FROM orders) c CROSS JOIN (SELECT unnest(range(1992, 2002)) AS y) y LEFT JOIN (SELECT DISTINCT o_custkey AS cik, year(o_orderdate) AS y FROM orders) h ON h.cik = c.cik AND h.y = y.y GROUP BY c.cik",
    "neighbour_records": "SELECT r.risk_id, t.risk_index AS target_index, r.risk_index - t.risk_index AS distance, s.n AS n_records, CASE WHEN s.n < 15 THEN 'few' WHEN s.n <= 70 THEN 'usual' ELSE 'many' END AS verdict FROM records r JOIN records t ON t.cik = r.cik AND t.fiscal_year = r.fiscal_year AND abs(r.risk_index - t.risk_index) <= 1 JOIN (SELECT cik, fiscal_year, count(*) AS n FROM records GROUP BY ALL) s ON s.cik = r.cik AND s.fiscal_year = r.fiscal_year",
    "filing_exclusions": """WITH o AS (SELECT o_custkey AS cik, year(o_orderdate) AS y, o_totalprice AS p FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999),
        v AS (SELECT cik, max(p) AS val FROM o GROUP BY cik HAVING max(p) BETWEEN 300000 AND 480000),
        m AS (SELECT v.cik, v.val, string_agg(CAST(CASE WHEN h.cik IS NULL THEN y.y END AS VARCHAR), ',' ORDER BY y.y) AS missing FROM v CROSS JOIN (SELECT unnest(range(1996, 2000)) AS y) y LEFT JOIN (SELECT DISTINCT cik, y FROM o) h ON h.cik = v.cik AND h.y = y.y GROUP BY v.cik, v.val)
        SELECT cik, CAST(cik AS VARCHAR) AS name, val, 'no_submissions_json' AS reason, '' AS detail FROM v WHERE cik % 5 = 0
        UNION ALL SELECT cik, CAST(cik AS VARCHAR), val, 'incomplete_10k_history', missing FROM m WHERE cik % 5 <> 0 AND missing IS NOT NULL
        UNION ALL SELECT * FROM (SELECT cik, CAST(cik AS VARCHAR), val, 'below_size_rank_cutoff', 'rank ' || n FROM (SELECT *, row_number() OVER (ORDER BY val DESC, cik) AS n FROM m WHERE cik % 5 <> 0 AND missing IS NULL) WHERE n > 20)""",
    "dashboard_tiles": "SELECT (SELECT count(DISTINCT ticker) FROM records) AS companies, (SELECT count(DISTINCT fiscal_year) FROM records) AS fiscal_years, (SELECT count(*) FROM records) + (SELECT count(*) FROM matches WHERE label = 'DROPPED') AS risk_factors, (SELECT count(*) FROM records r JOIN clean_category c ON c.risk_id = r.risk_id WHERE c.classifier = 'llm') AS llm_coverage, (SELECT count(*) FROM records r JOIN clean_category c ON c.risk_id = r.risk_id WHERE c.classifier = 'keywords') AS baseline_coverage, (SELECT count(*) FROM records WHERE cik = 3) + (SELECT count(*) FROM matches WHERE label = 'DROPPED' AND cik = 3) AS with_caveat",
    "dashboard_company": "SELECT r.fiscal_year, " + ", ".join(f"count(*) FILTER (WHERE r.yoy_label = '{x}') AS \"{x}\"" for x in ("NEW", "CARRIED_FORWARD", "MATERIALLY_REVISED", "DROPPED", "AMBIGUOUS")) + ", true AS caveat FROM (SELECT fiscal_year, label AS yoy_label FROM matches WHERE ticker = 'src3' AND (curr_id IS NOT NULL OR label = 'DROPPED')) r GROUP BY r.fiscal_year",
    "dashboard_search": f"SELECT fiscal_year, count(DISTINCT cik) AS companies FROM matches WHERE label = 'NEW' AND regexp_matches(substr(heading, 1, 240), '(?i){WIDE_THEME}') GROUP BY fiscal_year",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _list(*whens: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {w} THEN '{t}' END" for t, w in whens) + "], lambda x: x IS NOT NULL), "


_band = "CASE " + " ".join(f"WHEN similarity >= {a} AND similarity < {b} THEN '{a:.2f}-{b:.2f}'" for a, b in zip(BANDS, BANDS[1:], strict=False)) + " END"
_term = lambda t: re.sub(" +", r"\\s+", re.escape(t.lower()).replace("\\ ", " "))
_own = lambda text, terms: " + ".join(f"len(regexp_extract_all(lower(coalesce({text}, '')), {_quoted(EDGE + _term(t))}))" for t in terms)
_places = lambda k, pattern: f"""SELECT doc_id, '{k}' AS which, text, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS INT) AS pos, length(found[i]) AS len
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (SELECT doc_id, text, string_split_regex(text, {_quoted('(?i)' + pattern)}) AS pieces, regexp_extract_all(text, {_quoted('(?i)' + pattern)}) AS found FROM filings WHERE text IS NOT NULL))"""  # noqa: E731
_part = lambda start, stop: f"substr(text, greatest({start}, 0) + 1, CAST(greatest({stop} - greatest({start}, 0), 0) AS BIGINT))"
_m = lambda column, pattern: f"regexp_matches({column}, {_quoted(pattern)})"
_times = lambda n: f"repeat(text || ' ', CAST(ceil({n}.0 / greatest(length(text), 1)) AS INT))"
_used = {FILLED: _times(FILLED_TO), SHORT: f"substr(text, 1, {SHORT_TO})", LONG: _times(LONG_TO), BARE: "text"}
_plausible = f"section_end - pos BETWEEN {MIN_SECTION} AND {MAX_SECTION}"
_rules = [
    ("toc", -100, f"({_m('after', sections.CONTENTS_AFTER)} OR {_m('here60', sections.CONTENTS_PAGE)})"),
    ("xref_after", -60, _m("near", sections.REFERENCE_AFTER)),
    ("xref_before", -60, _m("before90", sections.REFERENCE_BEFORE)),
    ("quoted", -40, _m("here40", sections.QUOTED)),
    ("names_section", 30, _m("heading", r"(?i)risk\s*factors")),
    ("allcaps", 25, "(upper(heading) = heading AND lower(heading) <> heading)"),
    ("opener", 45, _m("near", sections.OPENING)),
    ("plausible_len", 25, _plausible),
]
CTE |= {
    "own_terms": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(_quoted(x) for x in row) + ")" for row in TERM_SENTENCES) + ") t(risk_id, heading, body) UNION ALL SELECT risk_id, heading, body FROM records",
    "own_scores": "SELECT risk_id, " + ", ".join(f"CAST(3 * ({_own('heading', t)}) + ({_own('body', t)}) AS BIGINT) AS score_{c}" for c, t in KEYWORDS.items()) + " FROM own_terms",
    "filings": "SELECT doc_id, text AS own, CASE kind " + " ".join(f"WHEN {i} THEN {_quoted(before)} || {_used[use]} || {_quoted(after)}" for i, (use, before, after) in enumerate(SKELETONS)) + f" END AS text FROM (SELECT *, CASE WHEN coalesce(doc_id, 0) % {LONG_EVERY} = {LONG_EVERY - 1} THEN {len(SKELETONS) - 1} ELSE coalesce(doc_id, 0) % {len(SKELETONS) - 1} END AS kind FROM documents)",
    "item_places": " UNION ALL ".join(_places(k, p) for k, p in [("start", sections.START), *[(k, p) for k, (p, _) in sections.ENDS.items()]]),
    "item_hits": f"SELECT doc_id, which, pos, pos + len AS stop, length(text) AS n, {_part('pos - 90', 'pos')} AS before90, {_part('pos - 80', 'pos')} AS before80, substr(text, pos + len + 1, 200) AS after, substr(text, pos + len + 1, 30) AS near, substr(text, pos + 1, len) AS heading, substr(text, pos + 1, 60) AS here60, substr(text, pos + 1, 40) AS here40, substr(text, pos + len + 1, 60) AS after60 FROM item_places",
    "judged_ends": "SELECT *, " + f"({_m('before80', sections.REFERENCE_BEFORE)} OR {_m('before80', sections.REFERRING)}) AS referred, CASE which " + " ".join(f"WHEN '{k}' THEN regexp_matches(regexp_replace(after60, '\\s+', '', 'g'), {_quoted('(?i)^' + sections.SEPARATORS + t)})" for k, (_, t) in sections.ENDS.items()) + " END AS title FROM item_hits WHERE which <> 'start'",
    "bounded": "SELECT s.*, coalesce(e.first.p, s.n) AS section_end, e.first.w AS stop_by FROM item_hits s LEFT JOIN (SELECT s.doc_id, s.pos, min(struct_pack(p := e.pos, w := e.which)) AS first FROM item_hits s JOIN judged_ends e ON e.doc_id = s.doc_id AND e.pos >= s.stop AND NOT e.referred AND e.title WHERE s.which = 'start' GROUP BY s.doc_id, s.pos) e ON e.doc_id = s.doc_id AND e.pos = s.pos WHERE s.which = 'start'",
    "beginnings": f"SELECT doc_id, pos, stop, section_end, stop_by, section_end - pos AS section_chars, CASE WHEN {_m('after', '^[ ]*[A-Z]')} THEN 5 ELSE 0 END + " + " + ".join(f"CASE WHEN {w} THEN {n} ELSE 0 END" for _, n, w in _rules) + f" AS score, {_list(*[(t, w) for t, _, w in _rules])} ',') AS why, {_plausible} AS plausible, round(100.0::DOUBLE * pos / greatest(n, 1), 1) AS start_pct FROM bounded",
    "sentences": r"SELECT doc_id, CAST(i - 1 AS INT) AS i, s[i] AS s FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), '. ') AS s FROM documents))",
    "runs": "SELECT doc_id, i AS idx, CASE WHEN i % 17 = 9 THEN i || ' Acme Bancorp Inc' WHEN i % 19 = 7 THEN 'Table of Contents' WHEN i = 2 AND doc_id % 2 = 0 THEN 'Risk Factor Summary' WHEN i % 12 = 6 THEN 'CREDIT AND MARKET RISKS' WHEN i % 23 = 11 THEN s ELSE s || '.' END AS raw, i % 6 = 0 OR (i = 2 AND doc_id % 2 = 0) AS bold, i % 13 = 1 AS italic, i % 29 = 3 AS underline, 10.0 + CASE WHEN i % 31 = 5 THEN 1 ELSE 0 END AS font_size, i * 100 AS start FROM sentences",
    "shaped": f"SELECT *, trim(raw) AS text, len(string_split_regex(trim(raw), ' +')) BETWEEN 3 AND 8 AND length(trim(raw)) BETWEEN 15 AND 60 AND NOT ({_m('trim(raw)', '[.?!:;]$')} AND NOT {_m('trim(raw)', '^ *[0-9]')}) AND ({_m('trim(raw)', '[0-9]')} OR {_m('trim(raw)', splitting.CORPORATE)}) AS header FROM runs",
    "marked": f"SELECT *, {_m('text', splitting.PAGE_NUMBER)} OR {_m('text', splitting.FURNITURE)} OR {_m('text', '^[^[:alnum:]a-zA-Z0-9' + chr(92) + 'p{{L}}]*$'.replace('{{', '{').replace('}}', '}'))} OR (length(text) <= 90 AND {_m('text', splitting.RUNNING)}) OR (header AND count(*) FILTER (WHERE header) OVER (PARTITION BY doc_id, lower(regexp_replace(text, '[0-9]+', '#', 'g'))) >= {HEADER_REPEATS}) AS is_furniture FROM shaped",
    "winner": "SELECT d.doc_id, b.pos, b.stop, b.section_end, b.stop_by, b.section_chars, b.score, b.why, b.start_pct, b.n_candidates, coalesce(b.viable, false) AS ok, CASE WHEN d.text IS NULL THEN 'no_text' WHEN b.viable IS NULL THEN 'no_item_1a_match' WHEN NOT b.viable THEN 'no_viable_candidate(best_score=' || b.score || ',len=' || b.section_chars || ')' END AS reason FROM documents d LEFT JOIN (SELECT *, score > 0 AND plausible AS viable, count(*) OVER (PARTITION BY doc_id) AS n_candidates, row_number() OVER (PARTITION BY doc_id ORDER BY score > 0 AND plausible DESC, score DESC, pos) AS nth FROM beginnings) b ON b.doc_id = d.doc_id AND b.nth = 1",
    "filing_pieces": "SELECT doc_id, i - 1 AS idx, length(pieces[i]) AS size FROM (SELECT doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM (SELECT doc_id, string_split(text, '. ') AS pieces FROM filings WHERE text IS NOT NULL))",
    "filing_runs": "SELECT *, start + size AS stop FROM (SELECT *, coalesce(sum(size + 2) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM filing_pieces)",
    "extracted": "SELECT w.*, md5(substr(f.text, w.pos + 1, w.section_end - w.pos)) AS section_md5, coalesce(c.n, 0) AS n_blocks, coalesce(c.bold, 0) AS n_bold_blocks, coalesce(c.italic, 0) AS n_italic_blocks, coalesce(c.styled, 0) AS n_styled_blocks FROM winner w LEFT JOIN filings f ON f.doc_id = w.doc_id AND w.ok LEFT JOIN (SELECT r.doc_id, count(*) AS n, count(*) FILTER (WHERE idx % 6 = 0) AS bold, count(*) FILTER (WHERE idx % 13 = 1) AS italic, count(*) FILTER (WHERE idx % 6 = 0 OR idx % 13 = 1 OR idx % 29 = 3) AS styled FROM filing_runs r JOIN winner w ON w.doc_id = r.doc_id AND w.ok AND r.start >= w.pos AND r.stop <= w.section_end GROUP BY r.doc_id) c ON c.doc_id = w.doc_id",
    "flagged": "SELECT doc_id, unnest(list_filter([CASE WHEN section_chars < 0.4::DOUBLE * middle THEN 'much shorter than median' END, CASE WHEN section_chars > 2.5::DOUBLE * middle THEN 'much longer than median' END, CASE WHEN stop_by IS NULL THEN 'no terminator found' END, CASE WHEN why LIKE '%xref%' THEN 'won despite a cross-reference penalty' END, CASE WHEN n_bold_blocks < 10 THEN 'almost no styled headings' END, CASE WHEN score < 50 THEN 'low confidence score' END], lambda x: x IS NOT NULL)) AS reason FROM extracted, (SELECT median(section_chars) AS middle FROM extracted WHERE ok) WHERE ok",
    "followed": "SELECT *, bold OR italic OR underline AS styled, lag(text) OVER w AS prev_text, lag(bold) OVER w = bold AND lag(italic) OVER w = italic AND lag(underline) OVER w = underline AND lag(font_size) OVER w = font_size AS same FROM marked WHERE NOT is_furniture WINDOW w AS (PARTITION BY doc_id ORDER BY idx)",
    "begun": f"SELECT *, prev_text IS NULL OR NOT same OR (styled AND NOT (length(text) = 0 OR {_m('text', '^[.,;:)' + chr(92) + ']!?]')} OR {_m('text', '^' + chr(92) + 'p{Ll}')} OR (length(text) < 15 AND NOT {_m('text', '^' + chr(92) + 'p{L}')}) OR {_m('rtrim(prev_text)', '[(' + chr(92) + '-' + chr(92) + '[—–]$')})) AS opens FROM followed",
    "islands": f"SELECT *, CASE WHEN opens OR {_m('text', '^[.,;:)' + chr(92) + ']]')} OR {_m('prev_text', '[(' + chr(92) + '-' + chr(92) + '[]$')} THEN '' ELSE ' ' END || text AS part, CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM begun",
    "merged": "SELECT doc_id, island AS idx, trim(string_agg(part, '' ORDER BY idx)) AS text, bool_or(styled) AS styled, min(start) AS start FROM islands GROUP BY doc_id, island",
    "run_pairs": "SELECT *, lead(text) OVER w AS next_text, lead(styled) OVER w AS next_styled FROM merged WINDOW w AS (PARTITION BY doc_id ORDER BY idx)",
    "first_labels": f"SELECT doc_id, idx, text, start, CASE WHEN NOT styled OR length(text) > {MAX_HEADING} THEN 'BODY' WHEN {_m('text', splitting.SECTION)} THEN 'DROP' WHEN length(text) <= {MAX_CATEGORY} AND coalesce(next_styled, false) AND NOT ends_with(text, '.') THEN 'CATEGORY' WHEN length(text) <= {MAX_CATEGORY} AND upper(text) = text AND lower(text) <> text THEN 'CATEGORY' WHEN coalesce(NOT next_styled AND length(next_text) >= {MIN_BODY}, false) AND NOT coalesce({_m('next_text', splitting.GOES_ON)}, false) THEN 'RISK' ELSE 'BODY' END AS label FROM run_pairs",
    "summaries": f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS nth, count(*) OVER (PARTITION BY doc_id) AS n_runs FROM first_labels",
    "summary_starts": f"SELECT s.*, f.first FROM summaries s LEFT JOIN (SELECT doc_id, min(nth) AS first FROM summaries WHERE {_m('text', splitting.SUMMARY)} GROUP BY doc_id) f ON f.doc_id = s.doc_id",
    "summary_ends": f"SELECT doc_id, min(nth) AS last FROM summary_starts WHERE nth > first AND nth < least(n_runs, greatest(floor(n_runs * {SUMMARY_SHARE}), first + 2)) AND label IN ('RISK', 'CATEGORY') AND NOT (len(string_split_regex(text, ' +')) <= 6 AND NOT {_m('rtrim(text)', '[.?!]$')}) GROUP BY doc_id",
    "run_labels": "SELECT s.doc_id, s.idx, s.text, s.start, coalesce(s.nth >= s.first AND s.nth < coalesce(e.last, s.first + 1), false) AS in_summary, CASE WHEN coalesce(s.nth >= s.first AND s.nth < coalesce(e.last, s.first + 1), false) THEN 'DROP' ELSE s.label END AS label FROM summary_starts s LEFT JOIN summary_ends e ON e.doc_id = s.doc_id",
    "in_records": "SELECT *, last_value(CASE WHEN label = 'CATEGORY' THEN text END IGNORE NULLS) OVER w AS category, sum(CASE WHEN label = 'RISK' THEN 1 ELSE 0 END) OVER w AS record FROM run_labels WHERE label <> 'DROP' WINDOW w AS (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)",
    "assembled": "SELECT doc_id, CAST(record - 1 AS INT) AS risk_index, max(text) FILTER (WHERE label = 'RISK') AS heading, max(category) FILTER (WHERE label = 'RISK') AS category, trim(coalesce(string_agg(text, ' ' ORDER BY idx) FILTER (WHERE label <> 'RISK'), '')) AS body, max(start) FILTER (WHERE label = 'RISK') AS start_char FROM in_records WHERE record > 0 AND label <> 'CATEGORY' GROUP BY doc_id, record",
}
_item = "trim(regexp_replace(substr(coalesce(heading, ''), 1, 400) || chr(10) || substr(coalesce(body, ''), 1, 900), '\\n{2,}', chr(10), 'g'), chr(10))"
SQL |= {
    "keyword_150_scores": "SELECT risk_id, " + ", ".join(f"score_{c}" for c in KEYWORDS) + ", CASE greatest(score_financial, score_operational, score_regulatory, score_strategic) WHEN score_financial THEN 'financial' WHEN score_operational THEN 'operational' WHEN score_regulatory THEN 'regulatory' ELSE 'strategic' END AS category, list_sort([score_financial, score_operational, score_regulatory, score_strategic])[4] - list_sort([score_financial, score_operational, score_regulatory, score_strategic])[3] AS margin FROM own_scores",
    "llm_batches_mock": f"SELECT risk_id, CASE length({_item}) % 4 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(KEYWORDS)) + " END AS category, 'v1' AS prompt_version, 'mock' AS model, '2024-01-01T00:00:00Z' AS run_utc, CAST(NULL AS VARCHAR) AS error FROM records",
    "match_audit_sample": f"SELECT kind, band, curr_id, prev_id, rejected_id, similarity, label FROM (SELECT *, row_number() OVER (PARTITION BY kind, band ORDER BY md5(a || '|' || b || 'audit'), a, b) AS nth FROM (SELECT *, CASE WHEN curr_id IS NOT NULL AND prev_id IS NOT NULL THEN 'accepted' ELSE 'rejected' END AS kind, coalesce(curr_id, rejected_id) AS a, coalesce(prev_id, rejected_id) AS b, {_band} AS band, row_number() OVER (PARTITION BY coalesce(curr_id, rejected_id), coalesce(prev_id, rejected_id) ORDER BY curr_id IS NULL, prev_id IS NULL) AS one FROM matches) WHERE one = 1 AND a IS NOT NULL AND b IS NOT NULL) ORDER BY nth, md5(a || '|' || b || 'audit'), a, b LIMIT 96",
    "match_band_samples": f"SELECT s.band, CAST(s.nth AS INT) AS nth, s.curr_id, s.prev_id, s.similarity, substr(p.heading, 1, 150) AS before, substr(c.heading, 1, 150) AS after FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5(curr_id || '|' || prev_id || 'bands'), curr_id) AS nth FROM (SELECT *, {_band} AS band FROM matches WHERE curr_id IS NOT NULL AND prev_id IS NOT NULL)) s JOIN records c ON c.risk_id = s.curr_id JOIN records p ON p.risk_id = s.prev_id WHERE s.nth <= 2",
    "section_terminators": f"SELECT doc_id, which, pos, stop, {_list(('preceded by referring language', 'referred'), ('not followed by expected title', 'NOT title'))} '; ') AS reasons, NOT referred AND title AS real FROM judged_ends",
    "section_candidates": "SELECT doc_id, pos, stop, section_end, stop_by, section_chars, score, why, plausible, start_pct FROM beginnings",
    "section_winner": "SELECT * FROM winner",
    "section_extract": "SELECT doc_id, ok, section_md5, n_blocks, n_bold_blocks, n_italic_blocks, n_styled_blocks FROM extracted",
    "suspicious_sections": "SELECT doc_id, reason FROM flagged",
    "suspicious_by_reason": "SELECT reason, count(*) AS n, array_to_string((list(doc_id ORDER BY doc_id))[1:10], ',') AS members FROM flagged GROUP BY reason",
    "section_item_gaps": """SELECT l.doc_id, l.last, l.pos_1A AS "pos_1A", min(h.pos - l.last) FILTER (WHERE h.which = '1B') AS "1B", min(h.pos - l.last) FILTER (WHERE h.which = '1C') AS "1C", min(h.pos - l.last) FILTER (WHERE h.which = '2') AS "2", l.ctx_1A AS "ctx_1A"
        FROM (SELECT doc_id, max(pos) AS last, array_to_string(list(CAST(floor(round(100.0::DOUBLE * pos / greatest(n, 1), 1) * 10) AS BIGINT) ORDER BY pos)[1:12], ',') AS pos_1A, array_to_string(list(substr(heading || after60, 1, 90) ORDER BY pos)[1:8], '|') AS ctx_1A FROM item_hits WHERE which = 'start' GROUP BY doc_id) l
        LEFT JOIN item_hits h ON h.doc_id = l.doc_id AND h.pos > l.last GROUP BY ALL""",
    "furniture": "SELECT doc_id, idx, is_furniture FROM marked",
    "merged_runs": "SELECT doc_id, idx, text, styled, start FROM merged",
    "run_labels": "SELECT doc_id, idx, label, in_summary FROM run_labels",
    "assembled_records": "SELECT doc_id, risk_index, heading, category, body, length(heading) + length(body) AS chars, start_char FROM assembled",
    "split_report": f"SELECT f.doc_id, f.furniture_dropped, coalesce(l.runs_after_merge, 0) AS runs_after_merge, coalesce(l.summary_runs_dropped, 0) AS summary_runs_dropped, coalesce(r.n_risks, 0) AS n_risks, coalesce(r.n_categories, 0) AS n_categories, coalesce(r.short_bodies, 0) AS short_bodies, coalesce(r.median_risk_chars, 0) AS median_risk_chars, coalesce(l.summary_runs_dropped, 0) > 0 AS has_risk_summary, {_list(('few', 'coalesce(r.n_risks, 0) < 15'), ('many', 'coalesce(r.n_risks, 0) > 70'), ('short bodies', 'coalesce(r.short_bodies, 0) > 0.2 * coalesce(r.n_risks, 0)'))} ';') AS flagged FROM (SELECT doc_id, count(*) FILTER (WHERE is_furniture) AS furniture_dropped FROM marked GROUP BY doc_id) f LEFT JOIN (SELECT doc_id, count(*) AS runs_after_merge, count(*) FILTER (WHERE in_summary) AS summary_runs_dropped FROM run_labels GROUP BY doc_id) l ON l.doc_id = f.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n_risks, count(DISTINCT category) AS n_categories, count(*) FILTER (WHERE length(body) < {MIN_BODY}) AS short_bodies, median(length(heading) + length(body)) AS median_risk_chars FROM assembled GROUP BY doc_id) r ON r.doc_id = f.doc_id",
    "run_profile": f"SELECT strategy, shape, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY strategy), 1) AS share FROM (SELECT p.strategy, {SHAPE} AS shape FROM (SELECT doc_id, raw AS t FROM runs WHERE bold) r JOIN (SELECT doc_id, CASE WHEN count(*) FILTER (WHERE bold) >= 20 THEN 'bold' ELSE 'NEEDS_FALLBACK' END AS strategy FROM runs GROUP BY doc_id) p ON p.doc_id = r.doc_id) GROUP BY strategy, shape",
}

_metrics = [
    ("missing_category", "fault_kept k WHERE NOT EXISTS (SELECT 1 FROM fault_named c WHERE c.fault = k.fault AND c.risk_id = k.risk_id)", "count(*)"),
    ("orphan_prior_risk", "fault_pointers k WHERE NOT EXISTS (SELECT 1 FROM fault_kept c WHERE c.fault = k.fault AND c.risk_id = k.prev_id)", "count(*)"),
    ("risk_factors", "fault_kept k", "count(*)"),
    ("min_risks_per_filing", "fault_sizes k", "min(k.n)"),
    ("filings", "fault_sizes k", "count(*)"),
]
CTE |= {
    "fault_names": "SELECT unnest(['sound', " + ", ".join(f"'{f}'" for f in FAULTS) + "]) AS fault",
    "fault_places": "SELECT *, row_number() OVER (ORDER BY CAST(cik AS VARCHAR) NULLS FIRST, fiscal_year) - 1 AS place FROM years",
    "fault_placed": "SELECT r.risk_id, r.cik, r.fiscal_year, r.risk_index, r.heading, r.body, coalesce(p.place, -1) AS place, count(*) OVER (PARTITION BY r.cik, r.fiscal_year) AS size FROM records r LEFT JOIN fault_places p ON p.cik = r.cik AND p.fiscal_year = r.fiscal_year",
    "fault_rows": """SELECT fault, risk_id, cik, CASE WHEN fault = 'wrong_fiscal_year' AND place = 5 THEN 2099 ELSE fiscal_year END AS fiscal_year, risk_index, heading, CASE WHEN fault = 'empty_bodies' AND place = 1 AND risk_index < 10 THEN '' ELSE body END AS body
        FROM fault_placed, fault_names WHERE NOT (fault = 'truncate_filing' AND place = 0 AND risk_index >= size // 2) AND NOT (fault = 'corrupt_json' AND place = 3)
        UNION ALL SELECT 'duplicate_rows', risk_id || '_again', cik, fiscal_year, risk_index + size, heading, body FROM fault_placed WHERE place = 2 AND risk_index < 5""",
    "fault_plain": f"SELECT *, CASE WHEN length(trim(coalesce(heading, ''))) < 10 THEN 'empty_heading' WHEN length(coalesce(body, '')) < {MIN_BODY} THEN 'short_body' END AS plain FROM fault_rows",
    "fault_judged": "SELECT *, coalesce(plain, CASE WHEN row_number() OVER (PARTITION BY fault, cik, fiscal_year, heading, plain IS NULL ORDER BY risk_index) > 1 THEN 'duplicate_heading_in_filing' END) AS reason FROM fault_plain",
    "fault_kept": "SELECT fault, risk_id, cik, fiscal_year FROM fault_judged WHERE reason IS NULL",
    "fault_sizes": "SELECT fault, cik, fiscal_year, count(*) AS n FROM fault_kept GROUP BY ALL",
    "fault_labels": "SELECT risk_id, category, lead(category) OVER (ORDER BY risk_id) AS next, first_value(category) OVER (ORDER BY risk_id) AS head, row_number() OVER (ORDER BY risk_id) AS nth FROM baseline",
    "fault_named": "SELECT DISTINCT fault, risk_id FROM fault_labels, fault_names WHERE CASE WHEN fault = 'empty_classification' AND nth <= 500 THEN '' WHEN fault = 'shifted_labels' THEN coalesce(next, head) ELSE category END <> ''",
    "fault_ghosts": "SELECT DISTINCT prev_id FROM (SELECT prev_id FROM matches WHERE prev_id <> '' ORDER BY prev_id, curr_id NULLS FIRST LIMIT 50)",
    "fault_pointers": "SELECT fault, CASE WHEN fault = 'broken_match_ids' AND prev_id IN (SELECT prev_id FROM fault_ghosts) THEN prev_id || '_GHOST' ELSE prev_id END AS prev_id FROM matches, fault_names WHERE prev_id <> ''",
    "fault_values": """SELECT 'corrupt_json' AS fault, 'error' AS kind, 'unreadable ' || cik || '_FY' || fiscal_year || '.json' AS name, 1 AS value FROM fault_places WHERE place = 3
        UNION ALL SELECT fault, 'error', 'fiscal year outside plausible range: ' || fiscal_year, count(*) FROM fault_kept WHERE fiscal_year NOT BETWEEN 2000 AND 2030 GROUP BY fault, fiscal_year
        UNION ALL SELECT fault, 'quarantine', reason, count(*) FROM fault_judged WHERE reason IS NOT NULL GROUP BY fault, reason
        UNION ALL """ + " UNION ALL ".join(f"SELECT f.fault, 'metric', '{name}', coalesce(v.n, 0) FROM fault_names f LEFT JOIN (SELECT k.fault, {value} AS n FROM {rows} GROUP BY k.fault) v ON v.fault = f.fault" for name, rows, value in _metrics),
    "fault_signals": """SELECT a.fault, a.kind, a.name, CAST(coalesce(b.value, 0) AS DOUBLE) AS before, CAST(a.value AS DOUBLE) AS after FROM fault_values a LEFT JOIN fault_values b ON b.fault = 'sound' AND b.kind = a.kind AND b.name = a.name
        WHERE a.fault <> 'sound' AND CASE a.kind WHEN 'error' THEN coalesce(b.value, 0) = 0 WHEN 'quarantine' THEN a.value > coalesce(b.value, 0) ELSE CASE WHEN b.value > 0 THEN abs(a.value - b.value) / b.value > 0.02 ELSE a.value > 0 END END""",
}
SQL["fault_detection"] = "SELECT f.fault, s.kind, s.name, s.before, s.after FROM fault_names f LEFT JOIN fault_signals s ON s.fault = f.fault WHERE f.fault <> 'sound'"


# Pages: a stack of open elements, token by token, in a recursion; its own way, beside the fold over paths.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_in = lambda column, values: f"{column} IN (" + ", ".join(_quoted(v) for v in sorted(values)) + ")"
_latest = lambda values: f"coalesce(list_max(list_transform(range(1, len(s) + 1), lambda j: CASE WHEN {_in('s[j].tag', values)} THEN j ELSE 0 END)), 0)"
_end = lambda when, kinds, within: f"CASE WHEN {when} AND {_latest(kinds)} > {_latest(within)} THEN s[1:{_latest(kinds)} - 1] ELSE s END"
_css = lambda pattern: f"regexp_matches(css, {_quoted(pattern)})"
_implied = "s"
for _kinds in dict.fromkeys(html.ENDS.values()):
    _opened = [k for k, v in html.ENDS.items() if v == _kinds]
    _implied = f"CASE WHEN kind = 'open' AND {_in('tag', _opened)} THEN ({_end('true', _kinds, [x for x in html.SCOPE if x not in _kinds])}) ELSE {_implied} END"
CTE |= {
    "page_tokens": f"SELECT page_id, x, row_number() OVER (PARTITION BY page_id ORDER BY nth) AS i, lower(regexp_extract(x, {_quoted(html.TAG)}, 1)) AS tag, regexp_extract(x, {_quoted(html.CSS)}, 1) || regexp_extract(x, {_quoted(html.CSS)}, 2) || regexp_extract(x, {_quoted(html.CSS)}, 3) AS css, CASE WHEN x = '<' OR NOT starts_with(x, '<') THEN 'text' WHEN starts_with(x, '</') THEN 'close' ELSE 'open' END AS kind FROM (SELECT page_id, unnest(found) AS x, generate_subscripts(found, 1) AS nth FROM (SELECT page_id, regexp_extract_all(html, {_quoted(html.TOKEN)}) AS found FROM pages)) WHERE x = '<' OR NOT starts_with(x, '<') OR (ends_with(x, '>') AND NOT regexp_matches(x, '(?i)^<([!?]|(script|style|title)\\b)'))",
    "page_state": f"""SELECT page_id, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(tag VARCHAR, nr BIGINT)[]) AS s FROM pages
        UNION ALL SELECT page_id, i, CASE WHEN kind = 'open' AND NOT ({_in('tag', html.VOID)} OR ends_with(x, '/>')) THEN list_append(s, struct_pack(tag := tag, nr := i)) WHEN kind = 'close' AND top > 0 THEN s[1:top - 1] ELSE s END FROM (
            SELECT page_id, i, kind, tag, x, {_implied} AS s, coalesce(list_max(list_transform(range(1, len(s) + 1), lambda j: CASE WHEN s[j].tag = tag THEN j ELSE 0 END)), 0) AS top FROM (
                SELECT page_id, i, kind, tag, x, {_end(f"kind = 'open' AND NOT {_in('tag', html.INLINE)}", ['p'], html.SCOPE)} AS s FROM (SELECT t.page_id, t.i, t.kind, t.tag, t.x, h.s FROM page_state h JOIN page_tokens t ON t.page_id = h.page_id AND t.i = h.i + 1)))""",
    "page_own": f"SELECT page_id, i, {_in('tag', ['b', 'strong'])} OR {_css(html.WEIGHT)} AS bold, {_in('tag', ['i', 'em'])} OR {_css(html.SLANT)} AS italic, tag = 'u' OR {_css(html.LINE)} AS underline, round_even(TRY_CAST(regexp_extract(css, {_quoted(html.SIZE)}, 1) AS DOUBLE) * CASE lower(regexp_extract(css, {_quoted(html.SIZE)}, 2)) " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in html.POINTS.items()) + f" END, 1) AS font_size, nullif(lower(regexp_extract(css, {_quoted(html.ALIGN)}, 1)), '') AS align FROM page_tokens WHERE kind = 'open'",
    "page_styles": "SELECT e.page_id, e.i, bool_or(o.bold) AS bold, bool_or(o.italic) AS italic, bool_or(o.underline) AS underline, arg_max(o.font_size, o.i) FILTER (WHERE o.font_size IS NOT NULL) AS font_size, arg_max(o.align, o.i) FILTER (WHERE o.align IS NOT NULL) AS align FROM (SELECT page_id, i, unnest(s).nr AS nr FROM page_state) e JOIN page_own o ON o.page_id = e.page_id AND o.i = e.nr GROUP BY e.page_id, e.i",
    "page_data": "SELECT page_id, i, replace(replace(replace(replace(replace(replace(x, '&quot;', '\"'), '&copy;', '\u00a9'), '&middot;', '\u00b7'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS data FROM page_tokens WHERE kind = 'text'",
    "page_marks": f"SELECT page_id, i, data, nullif(trim(regexp_replace(data, '{_SPACE}', ' ', 'g'), ' '), '') AS text FROM page_data UNION ALL SELECT page_id, i, NULL, NULL FROM page_tokens WHERE kind <> 'text' AND NOT {_in('tag', html.INLINE)}",
    "page_spaced": f"SELECT *, count(text) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) - 1 AS idx, coalesce(lag(text IS NULL OR regexp_matches(data, '{_SPACE}$')) OVER (PARTITION BY page_id ORDER BY i), true) AS apart FROM page_marks",
    "page_placed": f"SELECT *, CAST(sum(CASE WHEN text IS NOT NULL THEN length(text) + CASE WHEN idx > 0 AND (apart OR regexp_matches(data, '^{_SPACE}')) THEN 1 ELSE 0 END END) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS INT) AS stop FROM page_spaced",
    "page_runs": "SELECT p.page_id, CAST(p.idx AS INT) AS idx, p.text AS raw, coalesce(s.bold, false) AS bold, coalesce(s.italic, false) AS italic, coalesce(s.underline, false) AS underline, s.font_size AS own_size, coalesce(s.font_size, -1) AS font_size, s.align, CAST(p.stop - length(p.text) AS INT) AS start, p.stop FROM page_placed p LEFT JOIN page_styles s ON s.page_id = p.page_id AND s.i = p.i WHERE p.text IS NOT NULL",
}
_SPLITTING = ("shaped", "marked", "followed", "begun", "islands", "merged", "run_pairs", "first_labels", "summaries", "summary_starts", "summary_ends", "run_labels", "in_records", "assembled")
_of_pages = lambda text: re.sub(r"\b(" + "|".join(("runs", *_SPLITTING)) + r")\b", r"page_\1", text).replace("doc_id", "page_id")
CTE |= {f"page_{k}": _of_pages(CTE[k]) for k in _SPLITTING}
SQL |= {
    "page_blocks": "SELECT page_id, idx, raw AS text, bold, italic, underline, own_size AS font_size, align, start, stop FROM page_runs",
    "block_shapes": _of_pages(SQL["run_profile"]),
    "page_records": _of_pages(SQL["assembled_records"]),
}


_history = "(SELECT o_custkey AS cik, CASE WHEN o_orderkey % 5 = 0 THEN '10-K/A' WHEN o_orderkey % 7 = 0 THEN '8-K' ELSE '10-K' END AS form, CAST(o_orderkey AS VARCHAR) AS accession, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INT) END AS fiscal_year FROM orders)"
_judged = "CASE WHEN risk_index % 13 = 0 THEN 'F' WHEN risk_index % 11 = 0 THEN 'T' WHEN risk_index % 17 = 0 THEN 'M' WHEN risk_index % 7 = 0 THEN '?' WHEN risk_index % 5 = 0 THEN '' ELSE 'C' END"
_first = lambda kind, order: f"SELECT '{kind}' AS kind, CAST(row_number() OVER (ORDER BY {order}, doc_id) AS INT) AS rank, doc_id FROM reported QUALIFY rank <= 10"
CTE["reported"] = SQL["split_report"]
SQL |= {
    "dashboard_categories": "SELECT m.fiscal_year, count(DISTINCT m.cik) AS companies FROM matches m JOIN clean_category c ON c.risk_id = m.curr_id WHERE m.label = 'NEW' AND c.category IN ('operational', 'strategic') GROUP BY m.fiscal_year",
    "theme_headings": f"SELECT ticker, substr(heading, 1, 150) AS heading, review FROM matches WHERE label = 'NEW' AND fiscal_year = 2023 AND regexp_matches(heading, '(?i){WIDE_THEME}')",
    "split_audit_score": f"SELECT n, hits AS correct, unsure, round(hits / n, 6) AS accuracy, round({ALOW}, 6) AS low, round({AHIGH}, 6) AS high FROM (SELECT count(*) FILTER (WHERE label IN ('C', 'F', 'T', 'M')) AS n, count(*) FILTER (WHERE label = 'C') AS hits, count(*) FILTER (WHERE label = '?') AS unsure FROM (SELECT {_judged} AS label FROM records))",
    "split_extremes": " UNION ALL ".join(f"({_first(*x)})" for x in (("fewest records", "n_risks"), ("most records", "n_risks DESC"), ("shortest records", "median_risk_chars"))),
    "filing_index": "SELECT o_custkey AS cik, year(o_orderdate) AS fiscal_year, CAST(o_orderkey AS VARCHAR) AS accession FROM orders WHERE year(o_orderdate) IN (1996, 1997) AND o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) FILTER (WHERE year(o_orderdate) = 1996) > 0 AND count(*) FILTER (WHERE year(o_orderdate) = 1997) > 0 ORDER BY max(o_totalprice) DESC, o_custkey LIMIT 20)",
    "annual_reports": f"SELECT o.cik, o.fiscal_year, o.accession, o.period AS report_date, o.day AS filing_date, CAST(coalesce(a.n, 0) AS BIGINT) AS n_amendments, coalesce(a.which, '') AS amendment_accessions FROM (SELECT *, row_number() OVER (PARTITION BY cik, fiscal_year ORDER BY day, accession) AS nth FROM {_history} WHERE form = '10-K' AND period <> '') o LEFT JOIN (SELECT cik, fiscal_year, count(*) AS n, string_agg(accession, ';' ORDER BY accession) AS which FROM {_history} WHERE form = '10-K/A' AND period <> '' GROUP BY cik, fiscal_year) a ON a.cik = o.cik AND a.fiscal_year = o.fiscal_year WHERE o.nth = 1",
    "company_inspector": f"SELECT h.cik, h.form, h.day AS \"filingDate\", h.period AS \"reportDate\", h.fiscal_year, substr(h.period, 6, 2) <> '12' AS odd_year_end, h.fiscal_year BETWEEN 1992 AND 1998 AS wanted, m.missing FROM {_history} h LEFT JOIN (SELECT cik, array_to_string(list_filter(range(1992, 1999), lambda y: NOT list_contains(have, y)), ',') AS missing FROM (SELECT cik, list(DISTINCT fiscal_year) AS have FROM {_history} WHERE form <> '8-K' AND period <> '' GROUP BY cik)) m ON m.cik = h.cik WHERE h.form <> '8-K'",
    "primary_documents": "SELECT cik, accession, document FROM (SELECT cik, accession, name AS document, row_number() OVER (PARTITION BY cik, accession ORDER BY size DESC, name DESC) AS nth FROM (SELECT CAST(l_orderkey % 100 AS VARCHAR) AS cik, CAST(l_orderkey AS VARCHAR) AS accession, CASE WHEN l_linenumber % 3 = 0 THEN 'ex-' ELSE 'doc' END || l_partkey || CASE l_suppkey % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.txt' ELSE '.htm' END AS name, CAST(round(l_extendedprice * 100) AS BIGINT) AS size FROM lineitem) WHERE NOT ends_with(name, '.jpg') AND NOT starts_with(name, 'ex-')) WHERE nth = 1",
    "frame_sizes": "SELECT o_custkey AS cik, arg_max(CAST(o_orderkey AS VARCHAR), o_totalprice) AS name, max(o_totalprice) AS val FROM orders WHERE o_totalprice BETWEEN 50000 AND 300000 GROUP BY o_custkey",
}


def statements() -> dict[str, str]:
    return {k: sql(v) for k, v in SQL.items()}
