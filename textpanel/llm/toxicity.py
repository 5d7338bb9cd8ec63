"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are the words of a text (runs of letters, lower-cased) and the beginnings of longer words (their first `BEGIN`
bytes, which stand for stems where a language glues endings on), each as a 64-bit hash. A vector has a weight for every
term that any labelled example holds: (1 + ln tf) * idf * rf ** `POWER`, scaled to length 1. idf = ln((N + 1) / (df + 1)) + 1, with N
and df counted over all documents; rf = log2(2 + a / max(1, c)) is the relevance frequency of supervised term weighting,
where a and c of the toxic and of the other examples hold the term. Without rf, the nearest examples of a text are those
of its language and length, not those of its insults (figures in the README).

Examples with equal vectors are one entry. Entries lie in blocks of `BLOCK`, alike ones together. Terms that `COMMON` of
the examples hold are columns of a dense table: their part of all cosines is one matrix product for a batch of texts. All
other terms have their postings block by block, with the largest weight of each block. A query's bound of a block is the
largest common part in it and the largest weights of its other terms; the most promising blocks are scored exactly, and
then those whose bound reaches the k-th best cosine so far, so that the k nearest entries are exact. They vote by
1 / (distance + `SOFT`), an entry with the share of toxic ones among its examples.
The vote is calibrated on the examples themselves: each is scored without itself, and a logistic fit on the
votes' log odds turns votes into shares of toxic examples. The nearest entries' ids and cosines are the evidence.

At most `MAX_TRAIN` labelled documents (a parameter), chosen by a hash of their ids, make up the index. It goes to the
executors whole, bounded by that number; every document is counted and scored, whole.

Edge cases: a text without a known term, a null or empty one too, gets the examples' share of toxic ones; without
labelled examples every score is 0; documents with contradicting labels count as toxic; of the rows of one labelled id the
one with the smallest text is the example, so that repeated rows don't add examples; repeated rows get the same score;
ties of cosine go to the earlier entry; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import held_out, small_batches, stored, table
from textpanel.llm.jaccard import run_hashes

MAX_TRAIN = 3000
BEGIN = 5
NEIGHBOURS = 15
BLOCK = 64
#: Chosen by the examples' error when each is left out (powers 1 to 2, softness 0.02 to 0.6 and 9 to 25 neighbours were tried).
POWER, SOFT = 1.5, 0.1
EDGE, RIDGE = 0.02, 1e-3
#: Cosines are sums of 32-bit products.
SLACK = 1e-5
CUT = 0.3
COMMON = 0.05
BATCH = 250
#: Anything but ASCII that is no letter or digit, and the ASCII bytes that are no small letters: between words.
ODD = re.compile(r"[^\w\x00-\x7f]+")
BETWEEN = np.ones(256, bool)
BETWEEN[128:] = BETWEEN[ord("a") : ord("z") + 1] = False


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how often each occurs) of the words of a text and of the beginnings of its longer words."""
    whole, begun = run_hashes(ODD.sub(" ", (text or "").lower()), BETWEEN, BEGIN)
    return np.unique(np.concatenate([whole, begun]), return_counts=True)


def log_odds(vote):
    return np.log((vote + EDGE) / (1 + EDGE - vote))


def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [first, last), one range after another."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Index:
    """Entries and their block-max postings, in numpy arrays, so that it can be sent."""

    def __init__(self, examples: list[tuple[int | None, int, np.ndarray, np.ndarray]], df: np.ndarray | None = None, n_docs: int | None = None, k: int = NEIGHBOURS):
        """`examples`: (id, toxic, hashes, counts); `df`: of the sorted distinct hashes, in `n_docs` documents (default: in the examples)."""
        self.k, self.curve = k, None
        n = len(examples)
        toxic = np.array([e[1] for e in examples], np.float64)
        self.rate = float(toxic.mean()) if n else 0.0
        self.vocabulary, term = np.unique(np.concatenate([np.zeros(0, np.uint64), *[e[2] for e in examples]]), return_inverse=True)
        size = len(self.vocabulary)
        owner = np.repeat(np.arange(n), [len(e[2]) for e in examples])
        tf = np.concatenate([np.zeros(0), *[e[3] for e in examples]])
        of = np.bincount(term, minlength=size)
        a = np.bincount(term, toxic[owner], minlength=size)
        rf = np.log2(2 + a / np.maximum(1, of - a))
        df, n_docs = (of, n) if df is None else (df, n_docs)
        self.weight = (np.log((n_docs + 1) / (df + 1)) + 1) * rf**POWER
        w = (1 + np.log(tf)) * self.weight[term]
        norm = np.sqrt(np.bincount(owner, w * w, minlength=n))
        w = (w / np.where(norm > 0, norm, 1)[owner]).astype(np.float32)
        # Entries: examples with equal vectors. Alike ones lie side by side: by their heaviest common term, then by length.
        at = np.searchsorted(owner, np.arange(n + 1))
        groups: dict[bytes, list[int]] = {}
        for e in range(n):
            groups.setdefault(term[at[e] : at[e + 1]].tobytes() + w[at[e] : at[e + 1]].tobytes(), []).append(e)
        kind = np.full(n, -1)
        shared = np.flatnonzero(of[term] >= max(2, COMMON * n))
        heavy = shared[np.lexsort((term[shared], -w[shared], owner[shared]))]
        first = np.flatnonzero(np.diff(owner[heavy], prepend=-1))
        kind[owner[heavy[first]]] = term[heavy[first]]
        order = sorted(groups, key=lambda g: (kind[groups[g][0]], float(norm[groups[g][0]]), g))
        self.n = np.array([len(groups[g]) for g in order], np.int64)
        self.toxic = np.array([toxic[groups[g]].sum() for g in order])
        self.ids = [min((examples[e][0] for e in groups[g] if examples[e][0] is not None), default=None) for g in order]
        self.entry_of = {examples[e][0]: i for i, g in enumerate(order) for e in groups[g]}
        rank = np.full(n, -1)
        rank[[groups[g][0] for g in order]] = np.arange(len(order))
        kept = rank[owner] >= 0
        entry, term, w = rank[owner[kept]].astype(np.int32), term[kept].astype(np.int32), w[kept]
        common = np.flatnonzero(of >= max(2, COMMON * n))
        self.column = np.full(size, -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.table = np.zeros((len(common), len(order)), np.float32)
        dense = self.column[term] >= 0
        self.table[self.column[term[dense]], entry[dense]] = w[dense]
        entry, term, w = entry[~dense], term[~dense], w[~dense]
        self.blocks = -(-len(order) // BLOCK)
        by = np.lexsort((entry, term))
        self.entry, self.posting = entry[by], w[by]
        cell = term[by].astype(np.int64) * max(1, self.blocks) + entry[by] // BLOCK
        begins = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cell_at = np.append(begins, len(cell))
        self.cell_block = (cell[begins] % max(1, self.blocks)).astype(np.int32)
        self.cell_top = np.maximum.reduceat(self.posting, begins) if len(begins) else np.zeros(0, np.float32)
        self.term_at = np.searchsorted(cell[begins] // max(1, self.blocks), np.arange(size + 1))

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(terms by number, weights) of a text's terms that the vocabulary holds, of length 1."""
        h, tf = found
        if not len(self.vocabulary) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == h
        at = at[known]
        w = (1 + np.log(tf[known])) * self.weight[at]
        return at, w / (math.sqrt(float(w @ w)) or 1.0)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query (terms by number, weights) the k entries of highest cosine above 0, ties to the earlier entry."""
        k = k or self.k
        if not len(self.n):
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        wide = np.zeros((len(queries), len(self.table)), np.float32)
        for i, (at, weight) in enumerate(queries):
            c = self.column[at]
            wide[i, c[c >= 0]] = weight[c >= 0]
        part = wide @ self.table
        tops = np.maximum.reduceat(part, np.arange(0, len(self.n), BLOCK), axis=1)
        return [self.nearest_one(at, weight, common, top, k) for (at, weight), common, top in zip(queries, part, tops, strict=True)]

    def nearest_one(self, at: np.ndarray, weight: np.ndarray, common: np.ndarray, top: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rare = self.column[at] < 0
        first, last = self.term_at[at[rare]], self.term_at[at[rare] + 1]
        cells, q = spread(first, last), np.repeat(weight[rare], last - first)
        block = self.cell_block[cells]
        bound = top + np.bincount(block, self.cell_top[cells] * q, minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        found, cosine, least, done = np.zeros(0, np.int64), np.zeros(0), 0.0, 0
        for more in (8, self.blocks):
            take = order[done : done + more]
            take = take[(bound[take] > 0) & (bound[take] >= least - SLACK)]
            if not len(take):
                break
            wanted = np.zeros(self.blocks, bool)
            wanted[take] = True
            some = np.flatnonzero(wanted[block])
            lo, hi = self.cell_at[cells[some]], self.cell_at[cells[some] + 1]
            p = spread(lo, hi)
            fresh = spread(take * BLOCK, np.minimum(take * BLOCK + BLOCK, len(self.n)))
            value = (common + np.bincount(self.entry[p], self.posting[p] * np.repeat(q[some], hi - lo), minlength=len(self.n)))[fresh]
            found, cosine = np.concatenate([found, fresh[value > 0]]), np.concatenate([cosine, value[value > 0]])
            least = float(np.partition(cosine, -k)[-k]) if len(cosine) >= k else 0.0
            done += more
        if len(cosine) > k:
            near = cosine >= least
            found, cosine = found[near], cosine[near]
        best = np.lexsort((found, -cosine))[:k]
        return found[best], cosine[best]

    def votes(self, texts: list[str | None], own: list[tuple[int, int]] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(share of toxic votes, nearest entries, cosines) of each text; `own` are (entry, toxic) of examples that don't count themselves."""
        out = []
        for at in range(0, len(texts), BATCH):
            queries = [self.vector(terms(x)) for x in texts[at : at + BATCH]]
            for i, (near, cosine) in enumerate(self.nearest(queries, self.k + (own is not None)), at):
                n, toxic = self.n[near].astype(np.float64), self.toxic[near]
                if own is not None:
                    mine = near == own[i][0]
                    n, toxic = n - mine, toxic - mine * own[i][1]
                    near, cosine, n, toxic = (x[n > 0][: self.k] for x in (near, cosine, n, toxic))
                mass = 1 / (np.maximum(0.0, 1 - cosine) + SOFT)
                out.append((float((mass * toxic / n).sum() / mass.sum()) if len(near) else self.rate, near, cosine))
        return out

    def calibrate(self, votes: np.ndarray, toxic: np.ndarray) -> None:
        """Fits the logistic curve from the votes' log odds to the share of toxic examples, with targets pulled a little towards the middle."""
        ones = float(toxic.sum())
        x = np.stack([np.ones(len(votes)), log_odds(votes)], 1)
        wanted = np.where(toxic > 0, (ones + 1) / (ones + 2), 1 / (len(toxic) - ones + 2))
        curve = np.array([math.log((ones + 1) / (len(toxic) - ones + 1)), 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-x @ curve))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2), x.T @ (wanted - p) - RIDGE * curve)
            curve += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.curve = (float(curve[0]), float(curve[1])) if curve[1] > 0 else None

    def calibrated(self, vote: float) -> float:
        return 1 / (1 + math.exp(-self.curve[0] - self.curve[1] * float(log_odds(vote)))) if self.curve else self.rate

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[tuple[int, float]]]]:
        """(calibrated score, [(example, cosine)]) of each text"""
        if not len(self.n):
            return [(0.0, [])] * len(texts)
        return [(self.calibrated(v) if len(near) else self.rate, [(self.ids[e], float(c)) for e, c in zip(near[:3].tolist(), cosine[:3], strict=True) if self.ids[e] is not None]) for v, near, cosine in self.votes(texts)]


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label: str, max_train: int) -> DataFrame:
    """(key, toxic, text) of at most `max_train` labelled documents, chosen by a hash of the id; one row for each id."""
    by_key = labels.where(learn & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("toxic"))
    chosen = by_key.orderBy(F.xxhash64(F.lit("toxicity"), "key"), "key").limit(max_train)
    rows = docs.select(F.col(key).alias("key_of"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("key_of") == F.col("key"))
    return rows.groupBy("key", "toxic").agg(F.min("text").alias("text"))


def collected(sample: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(key, toxic, hashes, counts) of the sample, a bounded table, in order of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [terms(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([h.tobytes() for h, _ in made], pa.binary()), pa.array([n.astype("<i4").tobytes() for _, n in made], pa.binary())], names=["key", "toxic", "h", "n"])

    rows = sample.select("key", "toxic", "text").mapInArrow(run, f"key {sample.schema['key'].dataType.simpleString()}, toxic int, h binary, n binary").collect()
    return sorted(((r["key"], r["toxic"], np.frombuffer(r["h"], np.uint64), np.frombuffer(r["n"], "<i4")) for r in rows), key=lambda r: r[0])


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray, text: str) -> tuple[np.ndarray, int]:
    """(df of each term of the sorted vocabulary, number of documents), over all documents."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        total, n = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for body in batch.column(0).to_pylist():
                h = terms(body)[0]
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                total[at[known[at] == h]] += 1
                n += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(total[used], n), pa.int64())], names=["at", "n"])

    # As many rows as the sample has terms, and one for the number of documents.
    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = found.column("at").to_numpy(), found.column("n").to_numpy()
    sent.unpersist()
    df = np.zeros(len(vocabulary), np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return df, int(n[at < 0].sum())


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", max_train: int = MAX_TRAIN, k: int = NEIGHBOURS) -> Index:
    small_batches(docs.sparkSession)
    sample = stored(labelled_sample(docs, labels, learn, key, text, label, max_train), "toxicity-sample")
    examples = collected(sample)
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[e[2] for e in examples]]))
    if not len(vocabulary):
        return Index(examples, k=k)
    index = Index(examples, *document_frequencies(docs, vocabulary, text), k=k)
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, toxic, bodies = (batch.column(i).to_pylist() for i in range(3))
            made = sent.value.votes(bodies, [(sent.value.entry_of[i], y) for i, y in zip(keys, toxic, strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in made], pa.float64()), batch.column(1)], names=["vote", "toxic"])

    votes = sample.repartition("key").select("key", "toxic", "text").mapInArrow(run, "vote double, toxic int").toArrow()  # at most max_train rows
    sent.unpersist()
    index.calibrate(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy())
    return index


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """Per document: key, score, predicted, and the nearest examples as evidence."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias(key), F.col(text).alias("text_of"))
    sent = docs.sparkSession.sparkContext.broadcast(index)
    kind = src.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = sent.value.scores(batch.column(1).to_pylist())
            evidence = pa.array([[{"doc": i, "cosine": c} for i, c in e] for _, e in made], pa.list_(pa.struct([("doc", pa.int64()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.float64()), pa.array([int(m[0] >= cut) for m in made], pa.int32()), evidence], names=[key, "score", "predicted", "evidence"])

    return src.mapInArrow(run, f"`{key}` {kind}, score double, predicted int, evidence array<struct<doc: long, cosine: double>>")


def op3_query(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = train(docs, labels, ~held_out(F.col("doc_id")))
    return score(docs, index).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False))).select("doc_id", "held_out", "score", "predicted", "evidence")
