"""Spelling variants: words that differ in one character are grouped under the more frequent one.

Words are counted over all texts, each task adding up its own before anything is shuffled. Pairs are found by halves: of
two words that differ by one inserted, deleted or replaced character, either half of the one stands unchanged in the
other, at its beginning or at its end. Shards of segments hold every word's two halves in an Aho-Corasick automaton;
each word is scanned by the shards that could hold a half of a neighbour of its, at most eight. Where a segment is found
at an offset and with a length that go together, what remains of both words is compared through the forms it has with a
character left out, so that a segment shared by many words costs no more than a rare one, and then verified. A pair is
found by its left half if that stands, else by its right one, hence once. What a shard finds for a word is added up
there: how many neighbours, and the best of them; pairs are never emitted.

Segments of more than `HOT` words don't go to one shard: their words meet under (side, segment, remainder with a
character left out), by a join in the JVM. Such a key has few words at any size of the corpus, as they differ in one
character.

A word's form is its most frequent neighbour, if that is `MORE` times as frequent; forms are followed to the root by
doubling the step until nothing changes, which ends as frequencies grow along the way.

Edge cases: null and empty texts have no words; null ids count as empty ones; repeated rows count each; ties go to the
word that comes first in code-point order; very long texts are scanned whole; an empty table gives an empty table; other
columns are ignored. A given table of words may hold words of any length; null and empty ones are passed over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import beside, small_batches, stored, table

#: A run of letters, after A-Z have been lowered.
RUN = "[a-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, MORE, DAMAGE = 6, 5, 5, 199
#: Words that a task counts before it hands them on; segments of a shard; words of a segment that a shard takes.
KNOWN, SHARD, HOT = 300_000, 20_000, 10_000
SHARDS = 64


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int | None = DAMAGE, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n). A run of a document whose hash `damage` divides loses the character that the hash names; None damages nothing."""
    small_batches(docs.sparkSession)
    find = re.compile(f"{RUN}{{{length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here: dict[str, int] = {}
                for w in find(body.encode().lower().decode()):
                    here[w] = here.get(w, 0) + 1
                start = crc32(f"{doc}:".encode())
                for w, k in here.items():
                    if damage and not (h := crc32(w.encode(), start)) % damage:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < length:
                            continue
                    seen[w] = seen.get(w, 0) + k
                if len(seen) > KNOWN:
                    yield made()
        if seen:
            yield made()

    src = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")), text)
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def without_one(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def one_apart(a: str, b: str) -> bool:
    """True for words that differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def halves(word: Column, half: Column) -> Column:
    """A word's two segments with their sides: `half` characters from its beginning, and the rest up to its end."""
    return F.array(F.struct(F.lit("l").alias("side"), F.substring(word, F.lit(1), half).alias("segment")), F.struct(F.lit("r").alias("side"), F.substring(word, half + 1, F.length(word)).alias("segment")))


def segments(words: DataFrame) -> DataFrame:
    """(word, n, side, segment): the two halves that automata hold of each word."""
    return words.select("word", "n", F.inline(halves(F.col("word"), F.floor(F.length("word") / 2).cast("int"))))


def wanted(words: DataFrame) -> DataFrame:
    """(word, side, segment): the halves that neighbours of a word may have: those of words a character shorter, as long and a character longer."""
    size = F.length("word")
    left = [F.floor((size + d) / 2).cast("int") for d in (-1, 0, 1)]
    right = [(size + d - F.floor((size + d) / 2)).cast("int") for d in (-1, 0, 1)]
    sides = [F.struct(F.lit("l").alias("side"), F.substring("word", F.lit(1), k).alias("segment")) for k in left]
    sides += [F.struct(F.lit("r").alias("side"), F.substring(F.col("word"), size - k + 1, k).alias("segment")) for k in right]
    return words.select(F.col("word").alias("word"), F.inline(F.array_distinct(F.array(*sides))))


class Shard:
    """The halves of a shard's words in an automaton, and by segment what remains of their words."""

    def __init__(self, rows: Iterator[tuple[str, int, str, str]]):
        import ahocorasick

        self.scan = ahocorasick.Automaton()
        #: By side and segment: what remains of a word, or of it without a character, to the words.
        self.rest: dict[tuple[str, str], dict[str, list[tuple[str, int]]]] = {}
        for word, n, side, segment in rows:
            if segment:
                self.scan.add_word(segment, len(segment))
            rest = word[len(segment) :] if side == "l" else word[: -len(segment)]
            by = self.rest.setdefault((side, segment), {})
            for form in {rest} | without_one(rest):
                by.setdefault(form, []).append((word, n))
        self.scan.make_automaton()

    def neighbours(self, word: str) -> list[tuple[str, int]]:
        """Words of this shard one apart from `word`: each once, from whichever half finds it in all shards together."""
        out: dict[str, int] = {}
        size = len(word)
        for u, n in self.alike(("l", ""), word):  # halves of single letters, which no automaton holds
            if one_apart(u, word):
                out[u] = n
        for last, length in self.scan.iter(word):
            begin = last - length + 1
            # Offset and length go together: a left half begins the word, a right one ends it, and either is half of a word a character longer or shorter at most.
            if begin == 0 and 2 * length - 2 <= size <= 2 * length + 2:
                for u, n in self.alike(("l", word[:length]), word[length:]):
                    if one_apart(u, word):
                        out[u] = n
            if last == size - 1 and 2 * length - 2 <= size <= 2 * length + 2:
                for u, n in self.alike(("r", word[begin:]), word[:begin]):
                    if not word.startswith(u[: len(u) // 2]) and one_apart(u, word):
                        out[u] = n
        return list(out.items())

    def alike(self, where: tuple[str, str], rest: str) -> Iterator[tuple[str, int]]:
        by = self.rest.get(where)
        if by:
            for form in {rest} | without_one(rest):
                yield from by.get(form, ())


FOUND = "word string, n_near long, best_n long, best string"


def in_shard(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    rows = []
    if len(held) and len(asked):
        shard = Shard(zip(held["word"], held["n"], held["side"], held["segment"], strict=True))
        for word in asked["word"]:
            if near := shard.neighbours(word):
                best, n = min(near, key=lambda x: (-x[1], x[0]))
                rows.append((word, len(near), n, best))
    return pd.DataFrame(rows, columns=["word", "n_near", "best_n", "best"])


def through_hot(held: DataFrame, asked: DataFrame) -> DataFrame:
    """Neighbours by segments of many words: both sides meet under what remains without a character, verified by Levenshtein distance."""

    def forms(df: DataFrame, word: str) -> DataFrame:
        rest = F.when(F.col("side") == "l", F.substring(word, F.length("segment") + 1, F.length(word))).otherwise(F.substring(word, F.lit(1), F.length(word) - F.length("segment")))
        cut = F.transform(F.sequence(F.lit(1), F.length("rest")), lambda i: F.concat(F.substring("rest", F.lit(1), i - 1), F.substring(F.col("rest"), i + 1, F.length("rest"))))
        cut = F.when(F.length("rest") > 0, cut).otherwise(F.array().cast("array<string>"))
        return df.withColumn("rest", rest).withColumn("cut", F.array_distinct(cut)).select("*", F.explode(F.array_union(F.array("rest"), "cut")).alias("form"))

    u = forms(held.select(F.col("word").alias("u"), F.col("n").alias("u_n"), "side", "segment"), "u").select("u", "u_n", "side", "segment", "form", F.col("cut").alias("u_cut"))
    v = forms(asked.select("word", "side", "segment"), "word").select("word", "side", "segment", "form", "cut")
    met = u.join(v.hint("merge"), ["side", "segment", "form"])
    by_left = F.col("word").startswith(F.substring("u", F.lit(1), F.floor(F.length("u") / 2).cast("int")))
    # A pair may meet under several forms; the shorter remainder, or the first form that both have, is the one that counts.
    same = F.length("u") == F.length("word")
    once = F.when(same, F.col("form") == F.array_min(F.array_intersect("u_cut", "cut"))).otherwise(F.length("form") == F.least(F.length("u"), F.length("word")) - F.length("segment"))
    near = met.where(once & ((F.col("side") == "l") | ~by_left) & (F.levenshtein("u", "word") == 1))
    return near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("u_n")).alias("k"), F.col("u").alias("best"))).alias("m")).select("word", "n_near", (-F.col("m.k")).alias("best_n"), "m.best")


def near_words(words: DataFrame, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(word, n_near, best_n, best) of each word that has neighbours, for a stored table of distinct words with counts."""
    shards = SHARDS + 2 * words.count() // shard
    held, asked = segments(words), wanted(words)
    many = stored(held.groupBy("side", "segment").count().where(F.col("count") > hot).select("side", "segment"), "hot-segments")
    parts = []
    at = F.pmod(F.xxhash64("side", "segment"), F.lit(shards)).cast("int")
    if many.limit(1).count():
        many, on = beside(many, 64), ["side", "segment"]
        parts.append(through_hot(held.join(many, on, "left_semi"), asked.join(many, on, "left_semi")))
        held, asked = held.join(many, on, "left_anti"), asked.join(many, on, "left_anti")
    held = held.withColumn("shard", at)
    asked = asked.select(at.alias("shard"), "word").distinct()
    parts.append(held.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(in_shard, FOUND))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    best = F.min(F.struct((-F.col("best_n")).alias("k"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("m")).select("word", "n_near", (-F.col("m.k")).alias("best_n"), "m.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for a table of words with their forms, which never lead back: each step is twice as long as the one before."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        step += 1
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{step}")
        now = joined.select("word", "root")
        if not joined.where("moved").limit(1).count():
            return now


def grouped(words: DataFrame, more: int = MORE, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct words with counts."""
    words = stored(words.where("word <> ''").select("word", "n"), "words")
    near = near_words(words, shard, hot)
    frequent = F.col("best_n") >= more * F.col("n")
    known = stored(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n")), "near")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_query(spark, sf_dir):
    return grouped(word_counts(table(spark, sf_dir, "documents")))
