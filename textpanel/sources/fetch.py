"""Polite fetching of many URLs as a Spark job, with the transport given from outside and a cache of replies.

Tasks share one rate. A reply is a row: url, http_status, body, sha256, from_cache, error. 404 is an empty success; 403 and
other refusals are rows with an error and not the end of the job; 429, 5xx and a transport that fails are tried again after
the time that the server names or a random backoff, and in the end give a row with an error too.

The cache is a folder that all executors share, as a mounted file system. Bodies lie in it under their own digests, so that
equal bodies are stored once, and a small file per URL names status and digest. Files are put in place whole, by renaming,
so that a lost task leaves none half written; one that is damaged all the same counts as absent. What a manifest already
holds is skipped by the caller with an anti-join.

`spark.dataSource.register(PoliteFetch)` makes it a source: `spark.read.format("polite_fetch").options(urls=..., cache=...,
transport="package.module:function", per_second=6, tasks=4).load()`; `urls` is a file with a URL a line, which is read where
the work is done.
"""

from __future__ import annotations

import gzip
import hashlib
import importlib
import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textpanel.sources.pacing import Pace

#: (status, body, seconds to wait or None) for a URL.
Transport = Callable[[str], tuple[int, bytes, float | None]]
SCHEMA = "url string, http_status int, body binary, sha256 string, from_cache boolean, error string"
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]
TRIES, MOST_PATIENCE = 5, 60.0


@dataclass
class Reply:
    url: str
    status: int | None
    body: bytes | None = None
    from_cache: bool = False
    error: str | None = None

    def row(self) -> tuple:
        return self.url, self.status, self.body, None if self.body is None else hashlib.sha256(self.body).hexdigest(), self.from_cache, self.error


class Cache:
    """Replies by URL, bodies by their own digest."""

    def __init__(self, folder: str):
        self.folder = Path(folder)

    def places(self, url: str) -> Path:
        name = hashlib.sha256(url.encode()).hexdigest()
        return self.folder / "replies" / name[:2] / f"{name}.json"

    def body_place(self, digest: str) -> Path:
        return self.folder / "bodies" / digest[:2] / f"{digest}.gz"

    def get(self, url: str) -> Reply | None:
        try:
            said = json.loads(self.places(url).read_text())
            body = gzip.decompress(self.body_place(said["sha256"]).read_bytes())
        except (OSError, ValueError, KeyError, EOFError):
            return None
        return Reply(url, said["status"], body, True) if hashlib.sha256(body).hexdigest() == said["sha256"] else None

    def put(self, reply: Reply) -> None:
        digest = hashlib.sha256(reply.body).hexdigest()
        whole(self.body_place(digest), gzip.compress(reply.body, mtime=0))
        whole(self.places(reply.url), json.dumps({"url": reply.url, "status": reply.status, "sha256": digest, "bytes": len(reply.body)}).encode())


def whole(path: Path, content: bytes) -> None:
    """Writes a file beside its place and renames it into it."""
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    beside.write_bytes(content)
    os.replace(beside, path)


def fetch_one(url: str, transport: Transport, pace: Pace | None = None, cache: Cache | None = None, tries: int = TRIES) -> Reply:
    """The reply to a URL, from the cache if it is there; what can be kept is kept."""
    pace = pace or Pace(None)
    if cache and (known := cache.get(url)):
        return known
    status, error = None, ""
    for attempt in range(tries):
        pace.turn()
        wait = None
        try:
            status, body, wait = transport(url)
        except OSError as e:
            status, error = None, f"{type(e).__name__}: {e}"
        else:
            error = f"HTTP {status}"
            if status in (200, 404):
                reply = Reply(url, status, body if status == 200 else b"")
                if cache:
                    cache.put(reply)
                return reply
            if status != 429 and status < 500:
                return Reply(url, status, error="forbidden" if status == 403 else error)
        if wait is not None:
            pace.hold(min(wait, MOST_PATIENCE))
        else:
            pace.back_off(attempt)
    return Reply(url, status, error=f"gave up after {tries} attempts ({error})")


def fetch(urls: DataFrame, transport: Transport, per_second: float = 6.0, tasks: int = 1, cache: str | None = None) -> DataFrame:
    """(url, http_status, body, sha256, from_cache, error) for a frame with a column `url`; each URL is fetched once however often it is listed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace, kept = Pace(per_second, tasks, TaskContext.get().partitionId()), Cache(cache) if cache else None
        for batch in batches:
            for url in batch["url"]:  # a body may be large: a frame for each
                yield pd.DataFrame([fetch_one(url, transport, pace, kept).row()], columns=COLUMNS)

    return urls.select("url").where("url is not null").distinct().repartition(tasks, "url").mapInPandas(run, SCHEMA)


class _Share(InputPartition):
    def __init__(self, task: int):
        self.task = task


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.urls, self.cache, self.transport = options["urls"], options.get("cache"), options["transport"]
        self.per_second, self.tasks = float(options.get("per_second", 6.0)), int(options.get("tasks", 1))

    def partitions(self) -> list[InputPartition]:
        return [_Share(i) for i in range(self.tasks)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.transport.partition(":")
        transport = getattr(importlib.import_module(module), name)
        pace, kept = Pace(self.per_second, self.tasks, partition.task), Cache(self.cache) if self.cache else None
        with open(self.urls, encoding="utf-8") as lines:
            for line in lines:
                url = line.strip()
                # Equal URLs fall to one task, where the cache answers all but the first.
                if url and int(hashlib.sha256(url.encode()).hexdigest()[:8], 16) % self.tasks == partition.task:
                    yield fetch_one(url, transport, pace, kept).row()


class PoliteFetch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polite_fetch"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))
