"""Which companies belong to the panel: size, industry and a complete history; and whether they stayed the same companies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import FISCAL_YEARS, MAX_COMPANIES, SIC_CODES
from textpanel.functions.ranks import numbered
from textpanel.functions.text import fiscal_year, name_key

#: Names of shells, and the number above which a registrant is new.
SHELL = "newco|merger sub|mergersub|acquisition corp|holdco"
NEW_CIK = 1_900_000


def annual_reports(history: DataFrame) -> DataFrame:
    """(cik, fiscal_year, accession, report_date, filing_date, n_amendments, amendment_accessions): the earliest original of each year, amendments listed."""
    rows = history.where(F.col("form").isin("10-K", "10-K/A") & (F.coalesce("reportDate", F.lit("")) != "")).withColumn("fiscal_year", fiscal_year(F.col("reportDate")))
    first = F.row_number().over(Window.partitionBy("cik", "fiscal_year").orderBy("filingDate", "accessionNumber"))
    originals = rows.where("form = '10-K'").withColumn("nth", first).where("nth = 1")
    late = rows.where("form = '10-K/A'").groupBy("cik", "fiscal_year").agg(F.count("*").alias("n_amendments"), F.array_join(F.sort_array(F.collect_list("accessionNumber")), ";").alias("amendment_accessions"))
    out = originals.join(late, ["cik", "fiscal_year"], "left")
    return out.select("cik", "fiscal_year", F.col("accessionNumber").alias("accession"), F.col("reportDate").alias("report_date"), F.col("filingDate").alias("filing_date"), F.coalesce("n_amendments", F.lit(0)).alias("n_amendments"), F.coalesce("amendment_accessions", F.lit("")).alias("amendment_accessions"))


def missing_years(reports: DataFrame, years: tuple[int, ...] = FISCAL_YEARS) -> DataFrame:
    """(cik, missing): wanted years without a report, ascending."""
    have = reports.groupBy("cik").agg(F.collect_set("fiscal_year").alias("have"))
    return have.select("cik", F.array_except(F.array(*[F.lit(y).cast(reports.schema["fiscal_year"].dataType) for y in years]), "have").alias("missing"))


def select(sizes: DataFrame, companies: DataFrame, reports: DataFrame, most: int = MAX_COMPANIES, years: tuple[int, ...] = FISCAL_YEARS, *, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(selected, index of their filings, exclusions with reasons).

    Companies are ranked by size in ranges (`keep` writes a frame and reads it back).

    `sizes` (cik, name, val) holds the companies within the size band, `companies` (cik, sic, ...) what is known of them.
    Other industries are out of scope and aren't logged.
    """
    known = sizes.join(companies.drop("name"), "cik", "left").join(missing_years(reports, years), "cik", "left")
    absent = known.where("sic IS NULL").select("cik", "name", "val", F.lit("no_submissions_json").alias("reason"), F.lit("").alias("detail"))
    banks = known.where(F.col("sic").isin(*SIC_CODES)).withColumn("missing", F.coalesce("missing", F.array(*[F.lit(y) for y in years])))
    gaps = banks.where(F.size("missing") > 0).select("cik", "name", "val", F.lit("incomplete_10k_history").alias("reason"), F.array_join(F.transform("missing", lambda y: y.cast("string")), ",").alias("detail"))
    whole = numbered(banks.where(F.size("missing") == 0), [], [F.desc("val"), F.col("cik")], keep, "size_rank")
    small = whole.where(F.col("size_rank") > most).select("cik", "name", "val", F.lit("below_size_rank_cutoff").alias("reason"), F.concat(F.lit("rank "), F.col("size_rank").cast("string")).alias("detail"))
    chosen = whole.where(F.col("size_rank") <= most).drop("missing")
    index = reports.where(F.col("fiscal_year").isin(*years)).join(chosen.select("cik"), "cik", "left_semi")
    return chosen, index, absent.unionByName(gaps).unionByName(small)


def primary_document(items: DataFrame) -> DataFrame:
    """(cik, accession, document): the largest text or web page of a filing's folder that is no exhibit, index or report part."""
    name = F.lower("name")
    usable = name.rlike(r"\.(htm|html|txt)$") & ~name.rlike(r"^(ex-|ex_|exhibit)|-ex")
    return items.where(usable).groupBy("cik", "accession").agg(F.max_by("name", F.struct("size", "name")).alias("document"))


def continuity(companies: DataFrame, reports: DataFrame, window_start: str = "2021-01-01", years: tuple[int, ...] = FISCAL_YEARS) -> DataFrame:
    """(cik, name, signals, detail) of companies whose identity may have changed: renamed, once a shell, new to reporting, or unknown.

    `companies` has cik, name and formerNames (null where nothing is known).
    """
    former = companies.where("name IS NOT NULL").select("cik", "name", F.explode("formerNames").alias("f")).select("cik", "name", F.col("f.name").alias("old"), F.substring("f.to", 1, 10).alias("until"))
    real = former.where((name_key(F.col("old")) != name_key(F.col("name"))) & (F.coalesce("until", F.lit("")) >= window_start))
    shell = F.lower("old").rlike(SHELL)
    renamed = real.select("cik", F.when(shell, "SHELL_NAME").otherwise("renamed_in_window").alias("signal"), F.format_string("was '%s' until %s", "old", "until").alias("detail"))
    first = reports.groupBy("cik").agg(F.min("report_date").alias("first"))
    dated = companies.where("name IS NOT NULL").select("cik").join(first, "cik", "left")
    none = dated.where("first IS NULL").select("cik", F.lit("no_10k_found").alias("signal"), F.lit(None).cast("string").alias("detail"))
    recent = dated.where(F.substring("first", 1, 4).cast("int") >= min(years)).select("cik", F.lit("first_10k_in_window").alias("signal"), F.concat(F.lit("first report covers the period to "), F.col("first")).alias("detail"))
    unknown = companies.where("name IS NULL").select("cik", F.lit("no_submissions_json").alias("signal"), F.lit(None).cast("string").alias("detail"))
    all_signals = renamed.unionByName(none).unionByName(recent).unionByName(unknown)
    per = all_signals.groupBy("cik").agg(F.array_join(F.array_sort(F.collect_set("signal")), ";").alias("signals"), F.array_join(F.array_sort(F.collect_set("detail")), " | ").alias("detail"))
    return companies.select("cik", "name").join(per, "cik")


def short_histories(companies: DataFrame, history: DataFrame, window_start: str = "2021-01-01", new_cik: int = NEW_CIK) -> DataFrame:
    """The earlier audit: any former name, a recently given number, or a first filing within the window."""
    first = history.groupBy("cik").agg(F.min("filingDate").alias("first"))
    df = companies.join(first, "cik", "left")
    shell = F.exists("formerNames", lambda f: F.lower(f["name"]).rlike(SHELL))
    named = F.when(F.size("formerNames") > 0, F.when(shell, "SHELL_NAME").otherwise("former_names"))
    flags = F.filter(F.array(F.when(F.col("name").isNull(), "no_submissions_json"), named, F.when(F.col("cik").cast("long") > new_cik, "new_cik"), F.when(F.col("first") >= window_start, "short_history")), lambda x: x.isNotNull())
    return df.withColumn("signals", flags).where(F.size("signals") > 0).select("cik", "name", F.array_join("signals", ";").alias("signals"))


def inspect(history: DataFrame, years: tuple[int, ...] = FISCAL_YEARS) -> DataFrame:
    """Companies' annual reports, latest first, with year-ends outside December marked, and of each company the wanted years that none covers."""
    rows = history.where(F.col("form").startswith("10-K"))
    missing = missing_years(rows.where(F.coalesce("reportDate", F.lit("")) != "").select("cik", fiscal_year(F.col("reportDate")).alias("fiscal_year")), years)
    shown = rows.select("cik", "form", "filingDate", "reportDate", fiscal_year(F.col("reportDate")).alias("fiscal_year"), (F.substring("reportDate", 6, 2) != "12").alias("odd_year_end"), fiscal_year(F.col("reportDate")).isin(*years).alias("wanted"))
    return shown.join(missing, "cik", "left").orderBy("cik", F.desc("filingDate"), "reportDate", "form")
