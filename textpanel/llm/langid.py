"""Language identification by error-correcting output codes.

Every language gets a codeword of bits, far from all others. One binary classifier per bit, a logistic regression on
hashed byte n-grams (one to three bytes), predicts whether a text's language has that bit set. A text goes to the
codeword with the least loss over all bits, each bit weighted by how reliable it was in training; a text for which the
second codeword comes close is flagged as ambiguous.

The classifiers are fitted on at most `MAX_TRAIN` labelled documents (a parameter), spread evenly over the languages
and chosen by a hash of their ids; the languages themselves and their sizes are counted over all labelled documents.

Edge cases: a text that is null or has no letter is `und` with score 0; with a single language all other texts get it
with score 1, with none all texts are `und`; rows with null labels are predicted but not learned from; repeated rows get
the same prediction; an empty table gives an empty table. Very long texts are counted in pieces, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import held_out, small_batches, table

MAX_TRAIN = 1600
BITS = 12
FEATURES = 256 + 2 * (1 << BITS)
UNKNOWN = "und"
#: A text is ambiguous if the best codeword's probability, by loss, is below this.
SURE = 0.6
PIECE = 1 << 20
STEPS = 150


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte n-grams of the lower-cased text, whole."""
    raw = text.lower().encode("utf-8", "replace")
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, len(raw), PIECE):
        b = np.frombuffer(raw, np.uint8, min(PIECE + 2, len(raw) - at), at).astype(np.uint32)
        own = min(PIECE, len(b))
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        shift = np.uint32(32 - BITS)
        codes = np.concatenate([b[:own], 256 + (two[:own] * np.uint32(2654435769) >> shift), 256 + (1 << BITS) + (three[:own] * np.uint32(2246822519) >> shift)])
        total += np.bincount(codes, minlength=FEATURES)
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codebook(n: int) -> np.ndarray:
    """Codewords (+1, -1) of `n` languages, one a row: every split of the languages in two while there are few, else spread random words."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        splits = [x for x in product((1, -1), repeat=n) if x[0] == 1 and -1 in x]
        return np.array(splits, np.int8).T.reshape(n, len(splits))
    r = np.random.default_rng(7)
    width = max(15, int(np.ceil(10 * np.log2(n))))
    best, far = None, -1
    for _ in range(200):
        words = r.choice(np.array([-1, 1], np.int8), (n, width))
        distance = (width - words.astype(int) @ words.T.astype(int)) // 2 + width * np.eye(n, dtype=int)
        usable = np.abs(words.sum(0)) < n
        if usable.all() and distance.min() > far:
            best, far = words, distance.min()
    return best


@dataclass
class Model:
    langs: list[str]
    words: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # by bit

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)"""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        counts = ngram_counts(text)
        used = np.flatnonzero(counts)
        n = max(1, int(counts[:256].sum()))
        margin = (counts[used] / n) @ self.weights[used] + self.bias
        loss = (np.logaddexp(0, -self.words * margin) * self.trust).sum(1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        best = int(np.argmin(loss))
        return self.langs[best], float(p[best]), bool(p[best] < SURE)


def fit(langs: list[str], labels: np.ndarray, counts: np.ndarray) -> Model:
    """Logistic regression for all bits at once, by accelerated gradient descent on scaled n-gram frequencies."""
    words = codebook(len(langs))
    if len(langs) < 2:
        return Model(langs, words, np.zeros((FEATURES, 0)), np.zeros(0), np.zeros(0))
    x = (counts / np.maximum(1, counts[:, :256].sum(1, keepdims=True))).astype(np.float32)
    mean = x.mean(0)
    scale = 1 / np.sqrt(mean + 1e-5)
    x -= mean
    x *= scale
    y = words[labels].astype(np.float32)
    n = len(y)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(8):
        v = x.T @ (x @ v)
        v /= max(1e-12, np.linalg.norm(v))
    step = 1 / (0.25 * float(np.linalg.norm(x @ v)) ** 2 / n + 1e-4)
    w = np.zeros((x.shape[1], words.shape[1]), np.float32)
    b = np.zeros(words.shape[1], np.float32)
    ahead_w, ahead_b = w, b
    for k in range(STEPS):
        g = -y / (1 + np.exp(np.clip(y * (x @ ahead_w + ahead_b), -30, 30))) / n
        new_w, new_b = ahead_w - step * (x.T @ g + 1e-4 * ahead_w), ahead_b - step * g.sum(0)
        pull = k / (k + 3)
        ahead_w, ahead_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    right = ((x @ w + b) * y > 0).mean(0)
    weights = w * scale[:, None]
    return Model(langs, words, weights.astype(np.float64), (b - mean @ weights).astype(np.float64), np.maximum(0.05, 2 * right - 1))


def train(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", max_train: int = MAX_TRAIN) -> Model:
    """A model from the rows of `docs` for which `learn` is true and the label isn't null."""
    small_batches(docs.sparkSession)
    labelled = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if len(langs) < 2:
        return fit(langs, np.zeros(0, int), np.zeros((0, FEATURES)))
    each = max(1, max_train // len(langs))
    # About 1.3 times as many as wanted by hash, then exactly the first `each` of those: no task sees all of a language.
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, (1.3 * each + 20) / sizes[k])))]), F.col("lang"))
    luck = F.xxhash64(F.lit("langid"), F.col("key"))
    some = labelled.withColumn("luck", luck).where(F.pmod("luck", F.lit(1 << 40)) < share * (1 << 40))
    from pyspark.sql import Window

    chosen = some.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("luck", F.lit(1 << 40)), "key"))).where(F.col("nth") <= each).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = [], []
            for body in batch.column(1).to_pylist():
                c = ngram_counts(body)
                used = np.flatnonzero(c)
                at.append(used.astype("<u4").tobytes())
                n.append(c[used].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.binary()), pa.array(n, pa.binary())], names=["lang", "at", "n"])

    rows = chosen.mapInArrow(count, "lang string, at binary, n binary").collect()  # at most max_train rows
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r["at"], "<u4")] = np.frombuffer(r["n"], "<u4")
    place = {k: i for i, k in enumerate(langs)}
    return fit(langs, np.array([place[r["lang"]] for r in rows], int), counts)


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` of `docs` with lang_pred, score and ambiguous."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    src = docs.select(*keep, F.col(text).alias("text_of"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sent.value.predict(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64()), pa.array([m[2] for m in made], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, "lang_pred", "score", "ambiguous"])

    return src.mapInArrow(run, f"{schema}, lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without the rows that the model rejects: unknown ones and ambiguous ones."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            yield batch.filter(pa.array([not sent.value.predict(x)[2] for x in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~held_out(F.col("doc_id")))
    return predict(docs.select("doc_id", "text"), model, ["doc_id"]).withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False))).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
