"""Readers for the forms in which panels arrive: CSV exports, JSON documents, manifests, compressed filings, API payloads."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Submissions hold the filing history as one array per field.
HISTORY_FIELDS = ("form", "accessionNumber", "filingDate", "reportDate", "primaryDocument")
FILING_FIELDS = "form array<string>, accessionNumber array<string>, filingDate array<string>, reportDate array<string>, primaryDocument array<string>, isInlineXBRL array<int>, size array<long>"
SUBMISSION_SCHEMA = f"cik string, name string, sic string, sicDescription string, tickers array<string>, stateOfIncorporation string, formerNames array<struct<name:string,`from`:string,to:string>>, filings struct<recent:struct<{FILING_FIELDS.replace(' array', ':array')}>,files:array<struct<name:string>>>"
RISK = "struct<heading:string,category:string,body:string,chars:long,start_char:long>"
RECORDS_SCHEMA = f"cik long, ticker string, name string, fiscal_year int, accession string, source_url string, sha256 string, section_chars long, furniture_dropped long, summary_runs_dropped long, has_risk_summary boolean, runs_after_merge long, n_categories long, n_risks long, risks array<{RISK}>"


def csv_strings(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A CSV file with a header, all columns strings, doubled quotes and line breaks in quotes understood, empty cells null, a byte order mark taken off."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("mode", "PERMISSIVE")
    df = reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path) if columns else reader.csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def blank_as_empty(df: DataFrame) -> DataFrame:
    """String nulls to empty strings, as readers do that know no nulls."""
    return df.fillna("", subset=[c for c, t in df.dtypes if t == "string"])


def json_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable): one JSON document per file; a file that doesn't parse goes to the second frame with its name and text."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))
    bad = F.try_parse_json("text").isNull()
    return raw.where(~bad).withColumn("parsed", F.from_json("text", schema)).select("file", "parsed.*"), raw.where(bad)


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only log of JSON lines; damaged lines and failed fetches are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where("http_status = 200 AND stored_path IS NOT NULL")


def unpack_text(content: pd.Series) -> pd.Series:
    """Text of gzip or plain bytes, with undecodable bytes replaced; null for a damaged archive."""

    def one(b: bytes | None) -> str | None:
        try:
            return None if b is None else (gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b).decode("utf-8", "replace")
        except (OSError, EOFError, zlib.error):
            return None

    return content.map(one)


def compressed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, bytes, html, ok, reason) of stored filings; a damaged one keeps its row with a reason."""
    files = spark.read.format("binaryFile").load(path)
    df = files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), F.pandas_udf(unpack_text, "string")("content").alias("html"))
    return df.withColumns({"ok": F.col("html").isNotNull(), "reason": F.when(F.col("html").isNull(), "damaged_archive")})


def frame_values(frame: DataFrame, low: float, high: float) -> DataFrame:
    """(cik, name, val) of a payload {data: [{cik, entityName, val}]}: the largest value per cik within the band."""
    rows = frame.select(F.explode("data").alias("d")).select("d.cik", F.col("d.entityName").alias("name"), "d.val").where(F.col("val").between(low, high))
    return rows.groupBy("cik").agg(F.max_by("name", "val").alias("name"), F.max("val").alias("val"))


def filing_history(submissions: DataFrame, overflow: DataFrame | None = None) -> DataFrame:
    """One row per filing: the parallel arrays of the recent part, and of the overflow files (cik and the same arrays), zipped and flattened."""

    def flat(df: DataFrame, prefix: str) -> DataFrame:
        zipped = F.arrays_zip(*[F.col(f"{prefix}{c}").alias(c) for c in HISTORY_FIELDS])
        return df.select("cik", F.inline(zipped)).toDF("cik", *HISTORY_FIELDS)

    found = flat(submissions, "filings.recent.")
    return found if overflow is None else found.unionByName(flat(overflow, ""))


def numbers_or_null(df: DataFrame, *columns: str, kind: str = "long") -> DataFrame:
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {kind})") for c in columns})


def relation(spark: SparkSession, name: str, rows: list, schema: str) -> DataFrame:
    """A small relation given in code, registered under a name."""
    df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(name)
    return df


def text_version(spark: SparkSession, folder: str, name: str, version: str) -> str:
    """A prompt or rubric by version."""
    return spark.read.text(f"{folder}/{name}_{version}.txt", wholetext=True).first()[0]


def listed(column: Column, keys: Iterable) -> Column:
    """Membership in a static configuration of keys, false for an empty one."""
    keys = list(keys)
    return column.isin(keys) if keys else F.lit(False)
