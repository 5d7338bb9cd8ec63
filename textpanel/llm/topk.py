"""Exact top-k search by inner product, pruned with segment statistics of several resolutions.

A vector is cut into segments; of each segment the mean and the deviation (the norm of what is left when the mean is
taken off) are kept. For two vectors, length * mean * mean + deviation * deviation, added over the segments, is never
below their inner product, as a distance from the same statistics is never above theirs. The bound is taken with few
segments first and with more for what remains: a candidate is dropped as soon as its bound is below the k-th best
product found, and survivors get their exact product.

Queries and candidates are dealt out in blocks; a task joins one block of queries with one part of the candidates and
returns k rows per query at most, and the best k of those are the result. Both kinds of block have a bounded size. Before
that, every query is searched in one part, a sample by hash: its k-th best product there is a floor that the result can't
fall below, and all other parts prune with it from the coarsest bound on.

Edge cases: vectors that are null, empty or hold null or non-finite components (also after scaling) take no part, nor do
rows without an id; vectors are only compared at equal length; a query's own id is never its result, repeated rows of
another id are results each, and each row of a query's id is a query, the id's results being the best of all their
products, as the SQL states it; ties go to the smaller id; an empty table gives an empty table; other columns are ignored.
Products beyond 53 bits are computed with Python integers, and those beyond 64 bits are given as the nearest long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.llm.common import stored, table

SCALE = 1024
K = 10
SEGMENTS = (1, 4, 16)
QUERIES, PART = 8192, 4096


def scaled(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v): v holds floor(scale * x) of each component as a double; only vectors that take part."""
    x = F.col(vector)
    v = F.transform(x, lambda c: c.cast("double") * scale)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & fine).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def statistics(m: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose products bound the inner products: sqrt(length) * mean and deviation of each segment."""
    columns = []
    for part in np.array_split(np.arange(m.shape[1]), min(segments, m.shape[1])):
        x = m[:, part]
        mean = x.mean(1)
        columns += [mean * np.sqrt(len(part)), np.sqrt(((x - mean[:, None]) ** 2).sum(1))]
    return np.stack(columns, 1)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int = K, floors: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(query id, id, product) of each query's k best rows, ties to the smaller id; rows below a query's floor may be left out."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    large = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] >= 2.0**53
    levels = [(statistics(queries, s), statistics(rows, s)) for s in SEGMENTS if s <= queries.shape[1]]
    slack = 1e-9 * max(1.0, float(np.abs(levels[0][0]).max(initial=0)) * float(np.abs(levels[0][1]).max(initial=0)))

    def product(q: int, at: np.ndarray) -> np.ndarray:
        if not large:
            return rows[at] @ queries[q]
        return np.array([sum(int(a) * int(b) for a, b in zip(rows[i], queries[q], strict=True)) for i in at], object)

    out = []
    for q, own in enumerate(query_ids):
        left = np.flatnonzero(ids != own)
        done, found = np.zeros(0, np.int64), None
        floor = least = None if floors is None or np.isnan(floors[q]) else float(floors[q])
        for of_queries, of_rows in levels:
            bound = of_rows[left] @ of_queries[q]
            if least is not None:
                left, bound = left[bound >= least - slack], bound[bound >= least - slack]
            if len(left) > k:
                # The most promising ones give a k-th best product to prune with.
                first = left[np.argpartition(-bound, k - 1)[:k]]
                fresh = np.setdiff1d(first, done)
                values = product(q, fresh)
                found = values if found is None else np.concatenate([found, values])
                done = np.concatenate([done, fresh])
                if len(done) >= k:
                    least = float(sorted(found)[-k]) if floor is None else max(floor, float(sorted(found)[-k]))
        rest = np.setdiff1d(left, done)
        values = product(q, rest)
        at, score = (rest, values) if found is None else (np.concatenate([done, rest]), np.concatenate([found, values]))
        top = sorted(zip((-int(s) for s in score), ids[at].tolist(), strict=True))[:k] if large else [(-int(score[i]), int(ids[at[i]])) for i in np.lexsort((ids[at], -score))[:k]]
        out += [(int(own), i, -s) for s, i in top]
    return out


PAIRS = "query_id long, vec_id long, score long"


def ranked(partial: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score). `is_query` is a condition on the column `id`."""
    all_rows = stored(scaled(vectors, key, vector, scale).withColumns({"query": F.coalesce(is_query, F.lit(False)), "row": F.monotonically_increasing_id()}), "vectors")
    n, nq = all_rows.agg(F.count("*"), F.coalesce(F.sum(F.col("query").cast("long")), F.lit(0))).first()
    blocks, parts = max(1, -(-nq // QUERIES)), max(1, -(-n // PART))
    queries = all_rows.where("query").withColumns({"block": F.pmod(F.xxhash64(F.lit("q"), "row"), F.lit(blocks)), "d": F.size("v")})
    rows = all_rows.withColumns({"part": F.pmod(F.xxhash64(F.lit("c"), "row"), F.lit(parts)), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))), "d": F.size("v")})
    keys = ["block", "part", "d"]

    def both(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        made, low, high = [], -(2**63), 2**63 - 1
        if len(q) and len(c):
            floors = q["q_floor"].to_numpy(np.float64)
            floors = np.where(np.abs(floors) < 2.0**63, floors, np.nan)  # scores at the ends of the range are no products
            made = best(np.floor(np.stack(q["q_v"])), q["q_id"].to_numpy(), np.floor(np.stack(c["v"])), c["id"].to_numpy(), k, floors)
        return pd.DataFrame({"query_id": [m[0] for m in made], "vec_id": [m[1] for m in made], "score": [min(high, max(low, m[2])) for m in made]}).astype("int64")

    def within(q: DataFrame, some: DataFrame) -> DataFrame:
        own = q.select(*[F.col(c).alias(f"q_{c}") for c in (*keys, "id", "v", "floor")]).groupBy(*[f"q_{c}" for c in keys])
        return own.cogroup(some.select(*keys, "id", "v").groupBy(*keys)).applyInPandas(both, PAIRS)

    def in_parts(first: int) -> DataFrame:
        return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(parts - 1).cast("long")))

    none = F.lit(None).cast("double")
    if parts == 1:
        found = within(queries.withColumns({"part": F.lit(0).cast("long"), "floor": none}), rows)
    else:
        # The sample is a part of the search itself. An id with several query rows has one floor, which holds for them together.
        sample = stored(within(queries.withColumns({"part": F.lit(0).cast("long"), "floor": none}), rows.where("part = 0")), "sample-part")
        floors = ranked(sample, k).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").cast("double").alias("floor"))
        known = queries.join(floors, F.col("id") == F.col("of"), "left").drop("of")
        found = within(known.withColumn("part", in_parts(1)), rows.where("part > 0")).unionByName(sample)
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")


def op7_query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
