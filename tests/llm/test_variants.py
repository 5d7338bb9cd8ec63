import collections
import random
import re
import zlib

import duckdb
import pytest

from textpanel.llm import variants

SF = "/root/testdata/sf0.01"


def counted(rows):
    """Occurrences of words as the query counts them, run by run."""
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def brute(n):
    """Neighbours through every word's deletions, which is another way than by halves; `apart` alone decides."""

    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by = collections.defaultdict(set)
    for w in n:
        for f in [w, *[w[:i] + w[i + 1 :] for i in range(len(w))]]:
            by[f].add(w)
    out, form = {}, {}
    for w in n:
        near = {x for f in [w, *[w[:i] + w[i + 1 :] for i in range(len(w))]] for x in by[f] if apart(w, x)}
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(near)
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], out[w], n.get(form[w])))
    return rows


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


def test_query_equals_brute_force(spark, documents):
    got = [tuple(r) for r in variants.op12_query(spark, SF).collect()]
    want = brute(counted(documents))
    assert len(got) == len(set(got)) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 20


@pytest.mark.parametrize("hot", [1, 4, 10**6])
def test_hot_segments_and_shards_change_nothing(spark, hot):
    luck = random.Random(hot)
    words = {"".join(luck.choices("abé", k=luck.randint(1, 8))): luck.choice([1, 2, 5, 9, 30, 150, 800]) for _ in range(700)}
    words |= {f"aaaaa{x}{y}": luck.randint(1, 90) for x in "abcdef" for y in "abcdef"}
    got = {tuple(r) for r in variants.grouped(spark.createDataFrame(list(words.items()), "word string, n long"), shard=50, hot=hot).collect()}
    assert got == brute(words)


def test_roots_follow_long_chains(spark):
    chain = [("a" * i + "b" * (12 - i), 6**i) for i in range(12)]
    got = {r.word: (r.form, r.root) for r in variants.grouped(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {w: f for w, (f, _) in got.items()} == {w: nxt for (w, _), nxt in zip(chain, [*[c[0] for c in chain[1:]], None], strict=True)}
    assert {r for _, r in got.values()} == {chain[-1][0]}


def test_null_empty_long_and_repeated_texts(spark, monkeypatch):
    monkeypatch.setattr(variants, "KNOWN", 3)
    rows = [(None, "Straße STRASSE"), (1, None), (2, ""), (3, "word1 ÀÉÎÕÜß x"), (4, "lettersÿ " * 50_000), (5, "Abcdefg-abcdefg"), (5, "Abcdefg-abcdefg"), (5, "Abcdefg-abcdefg")]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, word string")
    got = {r.word: r.n for r in variants.word_counts(df).collect()}
    assert got == counted(rows) and got["lettersÿ"] == 50_000 and got["abcdefg"] == 6
    assert variants.grouped(variants.word_counts(df.limit(0))).collect() == []


def test_damage_comes_from_document_and_run(spark):
    rows = [(i, "abcdefghij " * 5) for i in range(400)]
    got = {r.word: r.n for r in variants.word_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == counted(rows) and len(got) > 1
