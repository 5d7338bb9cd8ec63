import gzip
import hashlib
import json
import os
from pathlib import Path

import pytest
import stub_transport
from pyspark.sql import functions as F

from textpanel.operators import external
from textpanel.sources import fetch, once
from textpanel.sources.pacing import Pace


class Clock:
    def __init__(self, now=0.0):
        self.now, self.waits = now, []

    def time(self):
        return self.now

    def sleep(self, seconds):
        self.waits.append(seconds)
        self.now += seconds


def paced(per_second, tasks=1, task=0, clock=None, luck=lambda a, b: b):
    clock = clock or Clock()
    return Pace(per_second, tasks, task, clock.time, clock.sleep, luck), clock


def test_tasks_together_keep_the_rate():
    times = []
    for task in range(5):
        pace, clock = paced(8 / 60, 5, task)
        for i in range(20):
            pace.turn()
            times.append(clock.now)
            clock.now += 3.0 * ((task + i) % 4)
    times.sort()
    assert len(times) == 100 and all(sum(t <= x < t + 60 for x in times) <= 8 for t in times)


def test_pauses_are_kept_and_repetitions_take_turns():
    pace, clock = paced(0.1)
    answers = iter([external.RateLimited(retry_after=45), external.RateLimited(), external.RateLimited(retry_after=900), '[{"id": 0, "category": "financial"}]'])
    asked = []

    def client(prompt):
        asked.append(clock.now)
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert external.ask([("h", "b")], client, "say", pace) == [("financial", None)]
    assert asked == [0, 45, 105, 225]
    pace, clock = paced(100.0)
    failing = external.ask([("h", "b")], lambda p: (_ for _ in ()).throw(external.Transient("odd")), "say", pace)
    assert failing == [(None, "odd")] and clock.now == pytest.approx(4 + 8 + 16)


def test_failed_items_are_asked_again_and_the_rate_holds_over_tasks(spark, tmp_path):
    log = str(tmp_path)

    def client(prompt):
        import time
        import uuid

        Path(log, uuid.uuid4().hex).write_text(repr(time.time()))
        return external.mock_client(prompt)

    df = spark.createDataFrame([(str(i), "heading", "body") for i in range(12)], "risk_id string, heading string, body string")
    done = spark.createDataFrame([("0", "financial"), ("1", None), ("2", "")], "risk_id string, category string")
    got = external.classify(df, client, "say", "v1", "m", "t", batch=1, done=done, rpm=600, tasks=3).collect()
    assert sorted(r.risk_id for r in got) == sorted(str(i) for i in range(1, 12)) and all(r.category for r in got)
    times = sorted(float(p.read_text()) for p in tmp_path.iterdir())
    assert len(times) == 11 and times[-1] - times[0] >= 0.1 * 8  # a task of four or more turns, three tenths apart each


def test_fetching_rules(tmp_path):
    pace, clock = paced(1.0)
    replies = iter([(429, b"", 2.0), (503, b"", None), (200, b"ok", None)])
    assert fetch.fetch_one("u", lambda _: next(replies), pace).body == b"ok"
    assert clock.now == pytest.approx(2.0 + 2.0)
    assert fetch.fetch_one("u", lambda _: (403, b"", None)).error == "forbidden" and fetch.fetch_one("u", lambda _: (410, b"", None)).error == "HTTP 410"
    pace, clock = paced(None)
    never = fetch.fetch_one("u", lambda _: (503, b"", 500.0), pace)
    assert never.error == "gave up after 5 attempts (HTTP 503)" and clock.now == pytest.approx(4 * 60.0)


def test_source_asks_once_and_keeps_failures_as_rows(spark, tmp_path):
    spark.dataSource.register(fetch.PoliteFetch)
    log, cache = tmp_path / "log", tmp_path / "cache"
    log.mkdir()
    urls = [f"{log}|{x}" for x in ("200|one", "200|one ", "200|two", "404|", "403|", "down|", "500|")]
    (tmp_path / "urls.txt").write_text("\n".join([*urls, urls[0], ""]))
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("stub_transport.py")))
    read = lambda: spark.read.format("polite_fetch").options(urls=str(tmp_path / "urls.txt"), cache=str(cache), transport="stub_transport:get", per_second="100000", tasks="3").load().collect()
    first = read()
    by = {r.url.split("|", 1)[1]: r for r in first}
    assert len(first) == 8 and by["200|one"].body == b"one" and by["200|one"].sha256 == hashlib.sha256(b"one").hexdigest()
    assert (by["404|"].http_status, by["404|"].body, by["404|"].error) == (404, b"", None) and by["403|"].error == "forbidden"
    assert by["down|"].http_status is None and "ConnectionError" in by["down|"].error and "gave up" in by["500|"].error
    asked = stub_transport.made(log)
    again = {r.url.split("|", 1)[1]: r for r in read()}
    assert again["200|two"].from_cache and again["404|"].from_cache and again["200|two"].body == b"two"
    assert [x for x in stub_transport.made(log) if x[:3] in ("200", "404")] == [x for x in asked if x[:3] in ("200", "404")]


def test_equal_bodies_are_stored_once_and_damage_is_a_miss(tmp_path):
    cache = fetch.Cache(str(tmp_path))
    for url in ("a", "b"):
        cache.put(fetch.Reply(url, 200, b"same"))
    bodies = list((tmp_path / "bodies").rglob("*.gz"))
    assert len(bodies) == 1 and cache.get("a").body == cache.get("b").body == b"same"
    bodies[0].write_bytes(gzip.compress(b"other"))
    assert cache.get("a") is None
    bodies[0].write_bytes(b"\x1f\x8b broken")
    assert cache.get("a") is None and cache.get("never") is None


def test_fetching_a_frame_of_urls(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    df = spark.createDataFrame([(f"{log}|200|x",), (f"{log}|200|x",), (f"{log}|403|",), (None,)], "url string")

    def get(url):
        Path(url.split("|")[0], os.urandom(8).hex()).write_text(url)
        return int(url.split("|")[1]), b"x", None

    got = fetch.fetch(df, get, per_second=1e6, tasks=2, cache=str(tmp_path / "c")).collect()
    assert sorted((r.http_status, r.body, r.error) for r in got if r.error is None) == [(200, b"x", None)] and [r.error for r in got if r.error] == ["forbidden"]
    assert len(list(log.iterdir())) == 2


def documents(spark, *rows):
    return spark.createDataFrame([(a, None if b is None else b.encode(), json.dumps({"n": i})) for i, (a, b) in enumerate(rows)], "accession string, body binary, meta string")


def test_each_accession_is_stored_once_with_its_digest(spark, tmp_path):
    folder = str(tmp_path / "store")
    once.put(documents(spark, ("a", "x"), ("b", "y"), ("b", "y"), (None, "z"), ("c", None)), folder)
    once.put(documents(spark, ("b", "other"), ("d", "w")).repartition(3), folder)
    got = {r.accession: r for r in once.stored(spark, folder).collect()}
    assert set(got) == {"a", "b", "c", "d"} and once.stored(spark, folder).count() == 4
    for r in got.values():
        body = gzip.decompress(Path(folder, r.stored_path).read_bytes())
        assert hashlib.sha256(body).hexdigest() == r.sha256 and len(body) == r.bytes_uncompressed
    assert got["b"].sha256 == hashlib.sha256(b"y").hexdigest()
    with pytest.raises(Exception, match="never overwritten"):
        documents(spark, ("a", "x")).write.format("write_once").option("path", folder).mode("overwrite").save()


def test_a_task_that_dies_leaves_nothing_that_counts(spark, tmp_path):
    folder = str(tmp_path / "store")
    spark.dataSource.register(once.WriteOnce)

    @F.udf("binary")
    def dies(accession, body):
        if accession == "9":
            raise RuntimeError("lost")
        return body

    rows = documents(spark, *[(str(i), f"text {i}") for i in range(10)]).repartition(4, "accession")
    with pytest.raises(Exception, match="lost"):
        rows.withColumn("body", dies("accession", "body")).write.format("write_once").option("path", folder).mode("append").save()
    assert once.stored(spark, folder).count() == 0
    writer = once._Writer(folder)
    lost = writer.write(iter([{"accession": "1", "body": b"text 1", "meta": None}]))
    kept = writer.write(iter([{"accession": "1", "body": b"text 1", "meta": None}]))
    writer.commit([kept, None, once.Staged(None)])  # the first attempt was killed between writing and commit
    assert once.stored(spark, folder).count() == 1
    once.put(rows, folder)
    got = [r.accession for r in once.stored(spark, folder).collect()]
    assert sorted(got) == sorted(set(got)) == sorted(str(i) for i in range(10))
    writer.abort([lost, None])
    assert not Path(folder, "documents", lost.name).exists() and once.stored(spark, folder).count() == 10
