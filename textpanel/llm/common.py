"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
ROWS = 1000
#: The size up to which a counted table is broadcast.
BROADCAST = 8 << 20


def small_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Arrow batches of texts hold at most so many rows in this session, so that a Python worker needs little memory beside an executor's heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; sets a temporary one only where the session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="textpanel-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df`, written once to the shared folder as Parquet and read back: lineage ends there, and any executor may be lost later."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside(df: DataFrame, row_bytes: int) -> DataFrame:
    """`df`, a stored table, as the smaller side of a join: broadcast if its rows take up to `BROADCAST` bytes, else joined by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST else df.hint("merge")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that no model may learn labels from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def own_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of `df`'s columns, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: str | None) -> list[str]:
    return re.findall(WORD, text or "")


def in_batches(rows: Iterator, size: int) -> Iterator[list]:
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) >= size:
            yield batch
            batch = []
    if batch:
        yield batch


Query = Callable[[SparkSession, str], DataFrame]
