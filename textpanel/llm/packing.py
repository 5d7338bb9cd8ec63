"""Best-fit packing of token pieces into sequences of a fixed capacity, by exact-complement hashing.

The plan is made on counts alone: how many pieces there are of each length, at most `capacity` numbers whatever the
input. Single lengths, sums of two and sums of three are indexed by what they add up to. Lengths are taken from the
longest down; the gap that a length leaves is looked up in the three indexes, and a combination that fills it exactly is
consumed as often as the counts allow. What no combination completes is packed best-fit, longest first. Every step uses
up a length, so the plan has a bounded number of patterns, and only the plan goes to the executors.

Pieces then take their places by rank: pieces of a length are numbered without gaps through buckets (a hot length
never meets in one task), and the rank tells pattern, copy of the pattern and slot.

Edge cases: a null or empty text is one piece that holds only the end id; repeated rows are packed each on their own;
a document longer than the capacity is cut, its first piece taking the remainder; an empty table gives an empty table;
other columns of the documents are ignored by `token_pieces`, and kept by `pack`, which names its own two columns by
`names` and replaces columns that have these names already.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpanel.llm.common import own_name, small_batches, stored, table
from textpanel.llm.tokens import memo

CAPACITY = 2048
END = 0
#: Pieces for which one more bucket per length is opened beyond the first 64.
PER_BUCKET = 5_000_000


def token_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, keep_ids: bool = False, known: int | None = None) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 (and ids, little-endian unsigned 32-bit, if asked for). `known` bounds a worker's memory of pieces."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    ending = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = memo(tokenizer, True, known)
        for batch in batches:
            out = [[], [], [], [], [], []]
            for key_at, ids in enumerate(memory.encode_all(batch.column(1).to_pylist())):
                ids += ending
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    size = ((n - at - 1) % capacity + 1) if at == 0 else capacity
                    part = ids[4 * at : 4 * (at + size)]
                    for column, value in zip(out, (key_at, piece, at, size, zlib.crc32(part), part), strict=True):
                        column.append(value)
                    at, piece = at + size, piece + 1
            columns = [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()), *[pa.array(x, pa.int64()) for x in out[2:5]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(out[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return src.mapInArrow(cut, schema)


class Sums:
    """What single, pair and triple sums of available lengths there are: for each sum the largest length that one can begin with.

    Counts only fall, so a beginning that is used up never comes back, and each entry only moves down.
    """

    def __init__(self, left: list[int]):
        self.left = left
        self.pairs, self.triples = [s - 1 for s in range(len(left))], [s - 2 for s in range(len(left))]

    def single(self, total: int, held: tuple[int, ...] = ()) -> list[int] | None:
        """`total` itself, if it is available beside one use of each length in `held`."""
        return [total] if total > 0 and self.left[total] > held.count(total) else None

    def there(self, held: tuple[int, ...]) -> bool:
        return all(self.left[x] >= held.count(x) for x in held)

    def pair(self, total: int, held: tuple[int, ...] = ()) -> list[int] | None:
        a = self.pairs[total]
        while 2 * a >= total and a > 0 and not self.there((a, total - a)):
            a -= 1
        self.pairs[total] = a
        while 2 * a >= total and a > 0:
            if self.there((a, total - a, *held)):
                return [a, total - a]
            a -= 1
        return None

    def triple(self, total: int, held: tuple[int, ...] = ()) -> list[int] | None:
        a = self.triples[total]
        while 3 * a >= total and a > 0 and not (self.left[a] and self.pair(total - a, (a,))):
            a -= 1
        self.triples[total] = a
        while 3 * a >= total and a > 0:
            if self.left[a] and (rest := self.pair(total - a, (a, *held))):
                return sorted([a, *rest], reverse=True)
            a -= 1
        return None

    def fill(self, gap: int, held: tuple[int, ...] = ()) -> list[int] | None:
        """One, two or three available lengths that add up to `gap`, the fewest there are."""
        return self.single(gap, held) or self.pair(gap, held) or self.triple(gap, held)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(copies, [(length, uses), ...])]: patterns whose lengths stand one after another in a sequence."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    patterns, sums = [], Sums(left)

    def use(lengths: list[int]) -> None:
        uses = sorted(Counter(lengths).items(), reverse=True)
        copies = min(left[x] // k for x, k in uses)
        for x, k in uses:
            left[x] -= copies * k
        patterns.append((copies, uses))

    for length in range(capacity, 0, -1):
        while left[length]:
            rest = [] if length == capacity else sums.fill(capacity - length, (length,))
            if rest is None:
                break
            use([length, *rest])
    for length in range(capacity, 0, -1):
        while left[length]:
            lengths, gap = [length], capacity - length
            spare = np.array(left)
            spare[length] -= 1
            while gap and len(fits := np.flatnonzero(spare[: gap + 1])):
                best = int(fits[-1])
                n = min(int(spare[best]), gap // best)
                spare[best] -= n
                lengths += [best] * n
                gap -= best * n
            use(lengths)
    return patterns


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, uses in a pattern, first sequence, first offset), ranks ascending."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for copies, uses in patterns:
        offset = 0
        for length, k in uses:
            rows.setdefault(length, []).append((ranks[length], k, sequence, offset))
            ranks[length] += copies * k
            offset += length * k
        sequence += copies
    return {x: np.array(r, np.int64) for x, r in rows.items()}


def pack(pieces: DataFrame, length: str = "length", order: tuple[str, ...] = (), capacity: int = CAPACITY, names: tuple[str, str] = ("sequence_id", "offset")) -> DataFrame:
    """`pieces` (a stored table) with the sequence and the place there. `order` makes the numbering within a length repeatable; it should tell all rows apart, so that equal ones are spread too."""
    spark = pieces.sparkSession
    pieces = pieces.drop(*[c for c in pieces.columns if c.lower() in {n.lower() for n in names}])
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(F.col(length).cast("long")).count().collect()}  # at most `capacity` rows
    if any(x < 1 or x > capacity for x in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    where = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    bucket, ahead, place, length_of, bucket_of = own_name(pieces, "bucket", "ahead", "place", "length_of", "bucket_of")
    buckets = max(64, -(-sum(counts.values()) // PER_BUCKET))
    keyed = pieces.withColumn(bucket, F.pmod(F.xxhash64(*(order or pieces.columns)), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy(F.col(length).alias(length_of), F.col(bucket).alias(bucket_of)).count()
    before = Window.partitionBy(length_of).orderBy(bucket_of).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(length_of, bucket_of, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(ahead))
    nth = F.row_number().over(Window.partitionBy(length, bucket).orderBy(*(order or pieces.columns)))
    ranked = keyed.join(sizes, (F.col(length) == F.col(length_of)) & (F.col(bucket) == F.col(bucket_of))).withColumn(ahead, F.col(ahead) + nth - 1)

    @F.pandas_udf("sequence_id long, offset long")
    def put(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(ranks), 2), np.int64)
        size, rank = lengths.to_numpy(), ranks.to_numpy()
        for x in np.unique(size):
            at = np.flatnonzero(size == x)
            rows = where.value[int(x)]
            row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
            local = rank[at] - row[:, 0]
            out[at, 0] = row[:, 2] + local // row[:, 1]
            out[at, 1] = row[:, 3] + local % row[:, 1] * x
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    out = ranked.drop(length_of, bucket_of, bucket).withColumn(place, put(F.col(length), F.col(ahead)))
    return out.withColumns({names[0]: F.col(f"{place}.sequence_id"), names[1]: F.col(f"{place}.offset")}).drop(place, ahead)


def packed_documents(docs: DataFrame, tokenizer: str, known: int | None = None) -> DataFrame:
    """The pieces of all documents with their places. Rows are numbered as they are stored, which tells equal ones apart."""
    pieces = stored(token_pieces(docs, tokenizer, known=known).withColumn("row", F.monotonically_increasing_id()), "pieces")
    return pack(pieces, order=("doc_id", "piece", "start", "ids_crc32", "row")).drop("row")


def op1_query(spark, sf_dir):
    import public_tokenizers

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
