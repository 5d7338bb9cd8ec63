"""A sink that keeps each document once, as a compressed file of its own, and commits in two phases.

`spark.dataSource.register(WriteOnce)`; `df.write.format("write_once").option("path", folder).mode("append").save()` takes
rows (accession, body binary, meta string): tasks put their files under a name of the task's own into `staged`, with a list
of what they wrote; the driver's commit gives every task's list to `manifest` by renaming one file each, and only listed
files count. A task that is aborted, lost or run again leaves files that no list names; `abort` removes those it knows of.
What passes the driver is one file name a task.

The folder is one that the driver and all executors see, as a mounted file system. `stored` reads the lists back, `new_only`
leaves out what they hold, and `put` does all three steps. An accession that comes twice in one write is kept once, the one
whose digest comes first.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from textpanel.sources.sinks import not_done

MANIFEST = "accession string, sha256 string, bytes_uncompressed long, stored_path string, meta string"


@dataclass
class Staged(WriterCommitMessage):
    name: str | None


class _Writer(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows: Iterator) -> WriterCommitMessage:
        root, name = Path(self.folder), uuid.uuid4().hex
        home, lines = root / "documents" / name, None
        for nth, row in enumerate(rows):
            if lines is None:
                home.mkdir(parents=True)
                (root / "staged").mkdir(exist_ok=True)
                lines = (root / "staged" / f"{name}.jsonl").open("w", encoding="utf-8")
            body = bytes(row["body"] or b"")
            path = home / f"{nth}.gz"
            path.write_bytes(gzip.compress(body, mtime=0))
            said = {"accession": row["accession"], "sha256": hashlib.sha256(body).hexdigest(), "bytes_uncompressed": len(body), "stored_path": str(path.relative_to(root)), "meta": row["meta"]}
            lines.write(json.dumps(said) + "\n")
        if lines is None:
            return Staged(None)
        lines.flush()
        os.fsync(lines.fileno())
        lines.close()
        return Staged(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        root = Path(self.folder)
        (root / "manifest").mkdir(parents=True, exist_ok=True)
        for m in messages:
            if m and m.name:
                os.replace(root / "staged" / f"{m.name}.jsonl", root / "manifest" / f"{m.name}.jsonl")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        root = Path(self.folder)
        for m in messages:
            if m and m.name:
                (root / "staged" / f"{m.name}.jsonl").unlink(missing_ok=True)
                shutil.rmtree(root / "documents" / m.name, ignore_errors=True)


class WriteOnce(DataSource):
    @classmethod
    def name(cls) -> str:
        return "write_once"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("what is stored is never overwritten")
        return _Writer(self.options["path"])


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """(accession, sha256, bytes_uncompressed, stored_path, meta) of all that is committed."""
    Path(folder, "manifest").mkdir(parents=True, exist_ok=True)
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def new_only(documents: DataFrame, folder: str) -> DataFrame:
    """Rows whose accession isn't stored yet, one for each; a null accession names nothing and is left out."""
    rows = not_done(documents.where("accession is not null"), stored(documents.sparkSession, folder), "accession")
    first = F.min_by(F.struct("body", "meta"), F.sha2("body", 256))
    return rows.groupBy("accession").agg(first.alias("d")).select("accession", "d.body", "d.meta")


def put(documents: DataFrame, folder: str) -> None:
    """Stores the documents (accession, body, meta) that aren't there yet."""
    spark = documents.sparkSession
    spark.dataSource.register(WriteOnce)
    new_only(documents, folder).write.format("write_once").option("path", folder).mode("append").save()
