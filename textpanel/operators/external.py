"""Classification by an external model, in batches, with replies checked strictly.

The client is given from outside: a function from a prompt to a reply. Each partition makes its batches; a batch whose
reply is malformed twice is asked again item by item. Requests keep to a budget that all tasks share, and failures that may
pass are followed by the pause that the model names, or by a random one that grows. Items that fail come back as rows with
an error, and a run is resumed by leaving out the ids that are done.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpanel.constants import CATEGORIES
from textpanel.sources.pacing import Pace
from textpanel.sources.sinks import not_done

BATCH, HEADING, BODY = 20, 400, 900
TRIES = 4
#: Seconds to wait where a limit names no time, and at most.
PATIENCE, MOST_PATIENCE = 60.0, 120.0
Client = Callable[[str], str]


class Malformed(ValueError):
    """A reply that isn't what was asked for."""


class Transient(RuntimeError):
    """A failure that may pass."""


class RateLimited(Transient):
    """The model asks for patience: for so many seconds, or as long as is usual."""

    def __init__(self, message: str = "rate limited", retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


def item_text(heading: str, body: str) -> str:
    """What the model sees of an item: beginnings of heading and body, without blank lines, which only separate items."""
    return re.sub("\n{2,}", "\n", f"{heading[:HEADING]}\n{body[:BODY]}").strip("\n")


def prompt_of(items: list[tuple[str, str]], instructions: str) -> str:
    listed = "\n\n".join(f"[{i}] {item_text(h, b)}" for i, (h, b) in enumerate(items))
    return f"{instructions}\n\n{listed}\n\nReply with a JSON list of {len(items)} objects with id and category."


def parse_reply(reply: str, n: int) -> list[str]:
    """The categories in order; anything but n objects with every id once and known categories is malformed."""
    try:
        rows = json.loads(reply)
    except ValueError as e:
        raise Malformed("not JSON") from e
    if not isinstance(rows, list) or len(rows) != n:
        raise Malformed("not a list of the right length")
    out: dict[int, str] = {}
    for r in rows:
        if not isinstance(r, dict) or not isinstance(r.get("id"), int) or isinstance(r.get("id"), bool) or not 0 <= r["id"] < n:
            raise Malformed("an id is missing or out of range")
        if r.get("category") not in CATEGORIES:
            raise Malformed("unknown category")
        if r["id"] in out:
            raise Malformed("an id occurs twice")
        out[r["id"]] = r["category"]
    return [out[i] for i in range(n)]


def ask(items: list[tuple[str, str]], client: Client, instructions: str, pace: Pace | None = None) -> list[tuple[str | None, str | None]]:
    """(category, error) of each item. Every request, repeated ones too, waits for its turn."""
    pace = pace or Pace(None)
    bad, last = 0, ""
    for attempt in range(TRIES):
        pace.turn()
        try:
            return [(c, None) for c in parse_reply(client(prompt_of(items, instructions)), len(items))]
        except Malformed as e:
            bad += 1
            if bad == 2:
                return [x for i in items for x in ask([i], client, instructions, pace)] if len(items) > 1 else [(None, str(e))]
        except RateLimited as e:
            last = str(e)
            pace.hold(min(PATIENCE if e.retry_after is None else e.retry_after, MOST_PATIENCE))
        except Transient as e:
            last = str(e)
            pace.back_off(attempt + 2)
    return [(None, last)] * len(items)


def classify(records: DataFrame, client: Client, instructions: str, version: str, model: str, run_utc: str, batch: int = BATCH, done: DataFrame | None = None, rpm: float | None = None, tasks: int | None = None) -> DataFrame:
    """(risk_id, category, prompt_version, model, run_utc, error)

    With `rpm`, records are dealt out to `tasks` tasks (default: the cores), which share so many requests a minute. Of
    `done`, rows with a category are left out of the run; items that failed are asked again.
    """
    if done is not None and "category" in done.columns:
        done = done.where("category <> ''")
    todo = records if done is None else not_done(records, done, "risk_id")
    src = todo.select("risk_id", F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("body", F.lit("")).alias("body"))
    if rpm:
        tasks = tasks or records.sparkSession.sparkContext.defaultParallelism
        src = src.repartition(tasks, "risk_id")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(rpm and rpm / 60, tasks, TaskContext.get().partitionId()) if rpm else Pace(None)
        for part in parts:
            rows = []
            for at in range(0, len(part), batch):
                some = part.iloc[at : at + batch]
                made = ask(list(zip(some["heading"], some["body"], strict=True)), client, instructions, pace)
                rows += [(rid, c, e) for rid, (c, e) in zip(some["risk_id"], made, strict=True)]
            yield pd.DataFrame(rows, columns=["risk_id", "category", "error"])

    found = src.mapInPandas(run, "risk_id string, category string, error string")
    return found.select("risk_id", "category", F.lit(version).alias("prompt_version"), F.lit(model).alias("model"), F.lit(run_utc).alias("run_utc"), "error")


def mock_client(prompt: str) -> str:
    """Answers by the length of each item's own text, for dry runs: the same for an item in whatever batch it comes."""
    blocks = [re.match(r"\[\d+\] ", b) and b for b in prompt.split("\n\n")]
    items = [b.split("] ", 1)[1] for b in blocks if b]
    return json.dumps([{"id": i, "category": CATEGORIES[len(x) % len(CATEGORIES)]} for i, x in enumerate(items)])
