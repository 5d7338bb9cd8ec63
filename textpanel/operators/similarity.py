"""TF-IDF similarity of records with those of the same company a year before, heading and body apart.

Blocks of a company's records meet blocks of the year before, where all their products are worked out; only what lies above
the floor, or is the best of a record, leaves the task. A term that occurs in one record only is left out (but not of its
vector's length). Where the floor is high and terms are rare, `candidates` tells the pairs that may lie above it by a
prefix-filtered join on terms: a record enters it with the terms by which a counterpart above the floor must be found, and
the others' greatest possible sum bounds what they may add.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from textpanel.constants import BODY_WEIGHT, EDGE_FLOOR, HEADING_WEIGHT
from textpanel.functions.packed import pack, unpack
from textpanel.functions.text import grams

#: Writes a frame and gives it back as it is read again.
Keep = Callable[[DataFrame], DataFrame]
#: Records of a block that is compared at once; records of a company's year that may meet under one term in one part; room for rounding in bounds.
BLOCK, HOT_TERM, SLACK = 128, 4096, 1e-9
#: Records and bytes of a company's year in a block whose products with another block one task works out, records of it that are unpacked at once, and products that it holds at once.
MEET, MEET_BYTES, SOME, CELLS = 49_152, 64 << 20, 4096, 1 << 17
#: Companies' years whose numbers of blocks are broadcast.
FEW_YEARS = 100_000
#: Terms that are multiplied densely: so many at most, each shared by this part of all pairs.
DENSE, DENSE_SHARE = 512, 0.02
#: Words whose hashes a worker remembers.
WORDS = 200_000
#: Parts of all hashes, by their first bits; entries of records that are packed together, records whose terms are found at once; chunks from here on are of records without an id.
PART_BITS, PACKED, AT_ONCE, NAMELESS = 9, 2_000_000, 512, 1 << 61
PARTS = 1 << PART_BITS
#: Decimals of a similarity. Copies of a text are equally near whatever order their terms are added in.
DIGITS = 12


def _long_terms(records: DataFrame, of: Callable[[Column], Column]) -> DataFrame:
    """(risk_id, cik, fiscal_year, field, e): what `of` makes of a field's terms in order, one row each, in as many tasks as there are cores or partitions."""
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), of(grams(F.col(f))).alias("terms")) for f in ("heading", "body")]))
    ids = ["risk_id", "cik", "fiscal_year"]
    spark = records.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return records.select(*ids, "heading", "body").repartition(tasks, "risk_id").select(*ids, fields.alias("f")).select(*ids, "f.field", F.explode("f.terms").alias("e"))


def term_counts(records: DataFrame) -> DataFrame:
    """(risk_id, cik, fiscal_year, field, term, tf)

    Records are dealt out by id before they are taken apart, so that their terms are counted where they are.
    """
    return _long_terms(records, lambda terms: terms).withColumnRenamed("e", "term").groupBy("risk_id", "cik", "fiscal_year", "field", "term").agg(F.count("*").alias("tf"))


def frequencies_of(records: DataFrame) -> DataFrame:
    """`document_frequencies` of records whose ids are their own: a record's distinct terms are found in its row, so that no table of a record's terms is gathered.

    Records without an id are one record by company and year.
    """
    named, nameless = records.where("risk_id IS NOT NULL"), records.where("risk_id IS NULL")
    own = _long_terms(named, F.array_distinct).select("field", F.col("e").alias("term"))
    return document_frequencies(own.unionByName(term_counts(nameless).select("field", "term")))


def document_frequencies(counts: DataFrame) -> DataFrame:
    return counts.groupBy("field", "term").agg(F.count("*").alias("df"))


def weights(records: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(risk_id, cik, fiscal_year, field, term, df, w): (1 + ln tf) * (ln((N + 1) / (df + 1)) + 1), not yet of length 1."""
    counts = term_counts(records) if counts is None else counts
    n = records.agg(F.count("*").alias("n"))
    idf = document_frequencies(counts).crossJoin(F.broadcast(n)).withColumn("idf", F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1)
    return counts.join(idf.drop("n"), ["field", "term"]).withColumn("w", (1 + F.log("tf")) * F.col("idf")).drop("tf", "idf")


def norms(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy("risk_id", "field").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def vectors(records: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Unit vectors in long form."""
    w = weights(records, counts)
    return w.join(norms(w), ["risk_id", "field"]).withColumn("w", F.col("w") / F.col("norm")).drop("norm")


def whole_vectors(weighted: DataFrame) -> DataFrame:
    """(cik, fiscal_year, risk_id, h, block, terms): one row per record with both fields as one vector, each field of its share's length.

    Terms are 64-bit hashes of field and term (among 10^9 terms, one pair in thirty such corpora has the same); terms of one
    record only are left out (but not of the length).
    `h` only needs to differ within a company's year, whose records fall into blocks of about `BLOCK`.
    """
    heading = F.col("field") == "heading"
    of = lambda f: F.sqrt(F.sum(F.when(f, F.col("w") * F.col("w"))))
    entry = F.struct(F.xxhash64("field", "term").alias("t"), "w", heading.alias("heading"))
    whole = weighted.groupBy("cik", "fiscal_year", "risk_id").agg(of(heading).alias("in_heading"), of(~heading).alias("in_body"), F.collect_list(F.when(F.col("df") > 1, entry)).alias("entries"))
    unit = lambda e: F.when(e["heading"], F.sqrt(F.lit(HEADING_WEIGHT)) * e["w"] / F.col("in_heading")).otherwise(F.sqrt(F.lit(BODY_WEIGHT)) * e["w"] / F.col("in_body"))
    terms = F.transform("entries", lambda e: F.struct(e["t"].alias("t"), unit(e).alias("x")))
    sizes = whole.groupBy("cik", "fiscal_year").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    h = F.xxhash64("risk_id")
    return whole.join(sizes, ["cik", "fiscal_year"]).select("cik", "fiscal_year", "risk_id", h.alias("h"), F.pmod(F.shiftright(h, 20), F.col("blocks")).cast("int").alias("block"), terms.alias("terms"))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    z = (z ^ (z >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


def hashed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records' terms as 64-bit hashes with their counts, one row each, from lower-cased texts."""
    seen: dict[str, int] = {}
    for batch in batches:
        rows, headings, t, tf = [], [], [], []
        for row, *texts in zip(*(batch.column(c).to_pylist() for c in ("row", "heading", "body")), strict=True):
            for field, text in enumerate(texts):
                words = re.findall("[a-z]+", text)
                if len(seen) > WORDS:
                    seen.clear()
                # A set minus a dictionary's keys would walk through all of these for each text.
                for w in {w for w in words if w not in seen}:
                    seen[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                h = np.fromiter((seen[w] for w in words), np.uint64, len(words))
                grams = np.concatenate([_mixed(h, np.array([field], np.uint64)), _mixed(_mixed(h[:-1], h[1:]), np.array([field + 2], np.uint64))])
                own, n = np.unique(grams, return_counts=True)
                rows.append(np.full(len(own), row, np.int64))
                headings.append(np.full(len(own), field == 0))
                t.append(own.view(np.int64))
                tf.append(n.astype(np.int32))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (rows, headings, t, tf)], names=["row", "heading", "t", "tf"])


def _row() -> Column:
    """A number for each record. Records without an id are one record by company and year, as where terms are counted by id."""
    return F.when(F.col("risk_id").isNull(), F.xxhash64("cik", "fiscal_year")).otherwise(F.xxhash64("risk_id"))


def packed_chunk(chunk: int, row: np.ndarray, heading: np.ndarray, t: np.ndarray, tf: np.ndarray, ids: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows (part, chunk, data, ids): the chunk's distinct hashes in order, one row for each part of all hashes, and one row with what each record has of them.

    Entries are in order of record, heading first, and hash; `row` is a record's place in `ids`.
    """
    u, place = np.unique(t.view(np.uint64), return_inverse=True)
    n = np.bincount(place)
    base = np.arange(PARTS, dtype=np.uint64) << np.uint64(64 - PART_BITS)
    bounds = [*np.searchsorted(u, base).tolist(), len(u)]
    parts = [p for p in range(PARTS) if bounds[p] < bounds[p + 1]]
    data = [pack(np.diff(u[bounds[p] : bounds[p + 1]], prepend=base[p]), n[bounds[p] : bounds[p + 1]] - 1) for p in parts]
    start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (heading[1:] != heading[:-1])]))
    gap = np.diff(place, prepend=0)
    gap[start] = place[start]
    data.append(pack(row[start], heading[start], np.diff(start, append=len(row)), gap, tf - 1))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ids[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        for x in ids:
            stream.write_batch(x)
    columns = [[*parts, -1 - chunk], [chunk] * len(data), data, [*[None] * len(parts), sink.getvalue().to_pybytes()]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["part", "chunk", "data", "ids"])


def packed_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of records with their terms, from lower-cased texts."""
    ids: list[pa.RecordBatch] = []
    found: list[pa.RecordBatch] = []

    def pieces() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(first, AT_ONCE)
                row = sum(x.num_rows for x in ids) + np.arange(some.num_rows)
                ids.append(some.select(["risk_id", "cik", "fiscal_year"]))
                yield pa.RecordBatch.from_arrays([pa.array(row), some.column("heading"), some.column("body")], names=["row", "heading", "body"])

    column = lambda c: np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in found])
    chunk = TaskContext.get().partitionId() << 24
    for x in hashed_counts(pieces()):
        found.append(x)
        if sum(x.num_rows for x in found) >= PACKED:
            yield packed_chunk(chunk, *[column(c) for c in ("row", "heading", "t", "tf")], ids)
            chunk += 1
            found.clear()
            ids.clear()
    if any(x.num_rows for x in found):
        yield packed_chunk(chunk, *[column(c) for c in ("row", "heading", "t", "tf")], ids)


def packed_nameless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of records without an id, from their counted terms, those of a record in one batch or in several that follow each other."""
    chunk = NAMELESS + (TaskContext.get().partitionId() << 24)
    held = None
    for batch in batches:
        batch = pa.Table.from_batches([batch])
        held = batch if held is None else pa.concat_tables([held, batch])
        rows = held.column("row").to_numpy()
        whole = int(np.searchsorted(rows, rows[-1])) if len(rows) >= PACKED else 0
        if whole:
            yield _nameless_chunk(chunk, held.slice(0, whole))
            held, chunk = held.slice(whole), chunk + 1
    if held is not None and held.num_rows:
        yield _nameless_chunk(chunk, held)


def _nameless_chunk(chunk: int, table: pa.Table) -> pa.RecordBatch:
    row, heading, t, tf = (table.column(c).to_numpy() for c in ("row", "heading", "t", "tf"))
    order = np.lexsort((t.view(np.uint64), ~heading, row))
    own, row = np.unique(row[order], return_inverse=True)
    nothing = pa.RecordBatch.from_arrays([pa.nulls(len(own), k) for k in (pa.string(), pa.int32(), pa.int32())], names=["risk_id", "cik", "fiscal_year"])
    return packed_chunk(chunk, row, heading[order], t[order], tf[order], [nothing])


def numbered_terms(key: tuple, table: pa.Table) -> pa.Table:
    """The chunks' hashes of a part as numbers: 0 for a term of one record only, else from 1 in order of frequency. One more row, of chunk -1, has the frequencies in order, each with how many terms have it.

    Rows of records are given back as they are.
    """
    part = key[0].as_py()
    if part < 0:
        return table
    keys, counts = [], []
    for data in table.column("data").to_pylist():
        gap, n = unpack(data)
        keys.append(np.cumsum(gap) + (np.uint64(part) << np.uint64(64 - PART_BITS)))
        counts.append(n + 1)
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    df = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
    shared = np.flatnonzero(df > 1)
    shared = shared[np.argsort(-df[shared], kind="stable")]
    number = np.zeros(len(df), np.int64)
    number[shared] = np.arange(1, len(shared) + 1)
    ends = np.cumsum([len(k) for k in keys])
    kinds, many = np.unique(-df[shared], return_counts=True)
    data = [*[pack(number[p]) for p in np.split(place, ends[:-1])], pack(-kinds, many)]
    chunks = [*table.column("chunk").to_pylist(), -1]
    return pa.table({"part": pa.array([part] * len(data), pa.int64()), "chunk": pa.array(chunks, pa.int64()), "data": pa.array(data, pa.binary()), "ids": pa.nulls(len(data), pa.binary())})


def hashed_terms(records: DataFrame) -> DataFrame:
    """(part, chunk, data, ids): records' terms, packed, and how often these occur.

    Records stay where they are. A chunk of them sends each of its distinct terms' hashes to that hash's part once; the part
    counts them and sends back numbers in the same order. No term travels with the record that has it.
    """
    texts = [F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in ("heading", "body")]
    kind = "part bigint, chunk bigint, data binary, ids binary"
    named = records.where("risk_id IS NOT NULL").select("risk_id", "cik", "fiscal_year", *texts).mapInArrow(packed_terms, kind)
    nameless = records.where("risk_id IS NULL").select(_row().alias("row"), *texts).mapInArrow(hashed_counts, "row bigint, heading boolean, t bigint, tf int")
    nameless = nameless.groupBy("row", "heading", "t").agg(F.sum("tf").cast("int").alias("tf")).repartition("row").sortWithinPartitions("row").mapInArrow(packed_nameless, kind)
    return named.unionByName(nameless).groupBy("part").applyInArrow(numbered_terms, kind)


def _frequencies(terms: DataFrame, n: int) -> list[np.ndarray]:
    """(n, ends, df): numbers of terms up to an end, within their part, have that frequency. As many rows as there are different frequencies, by part."""
    ends, dfs = [], []
    for part, data in terms.where("chunk = -1").select("part", "data").orderBy("part").collect():
        df, many = unpack(bytes(data))
        ends.append((np.uint64(part) << np.uint64(40)) + np.cumsum(many))
        dfs.append(df)
    nothing = [np.array([], np.uint64)]
    return [np.array([n], np.uint64), np.concatenate(ends or nothing), np.concatenate(dfs or nothing)]


def _idf(terms: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Of terms by their numbers over all parts; -1 stands for any that only one record has."""
    n, ends, dfs = known
    df = np.ones(len(terms))
    some = terms >= 0
    at = terms[some]
    df[some] = dfs[np.searchsorted(ends, (at % PARTS << 40 | at // PARTS).astype(np.uint64), side="right")]
    return np.log((int(n[0]) + 1) / (df + 1)) + 1


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _summed(gaps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of gaps, each run of them from 0."""
    upto = np.cumsum(gaps.astype(np.int64))
    before = np.concatenate([[0], upto])[_starts(sizes)]
    return upto - np.repeat(before, sizes)


def _fields(table: pa.Table, known: list[np.ndarray]) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row, heading, size, term, tf, norm) of a chunk: row, heading, size and norm of each field of a record, term and tf of each entry."""
    numbers = np.empty(0, np.int64)
    for part, data, ids in sorted(zip(*(table.column(c).to_pylist() for c in ("part", "data", "ids")), strict=True), key=lambda x: x[0] % (1 << 63)):
        if part < 0:
            row, heading, size, gap, tf = (x.astype(np.int64) for x in unpack(data))
            who = pa.ipc.open_stream(ids).read_all()
        else:
            own = unpack(data)[0].astype(np.int64)
            numbers = np.concatenate([numbers, np.where(own > 0, (own - 1) * PARTS + part, -1)])
    term = numbers[_summed(gap, size)]
    w = (1 + np.log(tf + 1)) * _idf(term, known)
    return who, row, heading > 0, size, term, tf, np.sqrt(np.add.reduceat(w * w, _starts(size)))


def norms_of(records: DataFrame, terms: DataFrame) -> DataFrame:
    """(risk_id, field, norm), as `norms`, from kept `hashed_terms`."""
    known = _frequencies(terms, records.count())

    def found(key, table):
        who, row, heading, _, _, _, norm = _fields(table, known)
        return pa.table({"risk_id": who.column("risk_id").combine_chunks().take(pa.array(row)), "field": pa.array(np.where(heading, "heading", "body"), pa.string()), "square": norm * norm})

    squares = terms.where("chunk >= 0").groupBy("chunk").applyInArrow(found, "risk_id string, field string, square double")
    return squares.groupBy("risk_id", "field").agg(F.sqrt(F.sum("square")).alias("norm"))


def vectors_of(records: DataFrame, terms: DataFrame) -> DataFrame:
    """(cik, fiscal_year, risk_id, h, terms): whole vectors, packed, of all records with an id and a company that share a term with any other, from kept `hashed_terms`; and one row without a company that tells how frequent terms are.

    A vector has the lengths of its fields over all their terms, and the shared terms' numbers and counts, headings first.
    """
    known = _frequencies(terms, records.count())
    kinds = ", ".join(f"{c} {records.schema[c].dataType.simpleString()}" for c in ("cik", "fiscal_year"))

    def found(key, table):
        who, row, heading, size, term, tf, norm = _fields(table, known)
        of = np.repeat(np.arange(len(size)), size)[term >= 0]
        tf, term = tf[term >= 0], term[term >= 0]
        order = np.lexsort((term, of))
        of, tf, term = of[order], tf[order], term[order]
        size = np.bincount(of, minlength=len(size))
        start = _starts(size)
        gap = np.diff(term, prepend=0)
        first = start[size > 0]
        gap[first] = term[first]
        begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        rows, vectors = [], []
        for a, b in zip(begins, [*begins[1:], len(row)], strict=True):
            lo, hi = start[a], start[b - 1] + size[b - 1]
            if lo < hi:
                # Where one field only is there, the other's length isn't asked for.
                lengths = np.array([norm[a], norm[b - 1]]).view(np.uint64)
                rows.append(row[a])
                vectors.append(pack(np.concatenate([[np.uint64(size[a] if heading[a] else 0)], lengths]), gap[lo:hi], tf[lo:hi]))
        of_row = {c: who.column(c).combine_chunks().take(pa.array(rows, pa.int64())) for c in ("cik", "fiscal_year", "risk_id")}
        return pa.table(of_row | {"terms": pa.array(vectors, pa.binary())})

    own = terms.where(f"chunk >= 0 AND chunk < {NAMELESS}").groupBy("chunk").applyInArrow(found, f"{kinds}, risk_id string, terms binary")
    own = own.where("cik IS NOT NULL").select("cik", "fiscal_year", "risk_id", F.xxhash64("risk_id").alias("h"), "terms")
    return own.unionByName(records.sparkSession.createDataFrame([(None, None, None, 0, bytearray(pack(*known)))], f"{kinds}, risk_id string, h bigint, terms binary"))


def prefixes(now: DataFrame, stats: DataFrame, floor: float) -> DataFrame:
    """The entries of each record by which any counterpart above the floor can be found, with the most that the others may add (`rest`).

    A term adds at most its weight times the greatest one that it has in the year before. Terms that lead to most records
    for the least of that are left out first, for as long as all those left out stay below the floor together.
    """
    may = F.col("x") * F.col("most")
    order = Window.partitionBy("cik", "fiscal_year", "h").orderBy((F.col("k") / may).desc(), "t")
    upto = F.sum("may").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = now.join(stats, ["cik", "fiscal_year", "t"]).withColumn("may", may).withColumn("upto", upto)
    out = F.col("upto") <= F.lit(floor - SLACK)
    rest = F.coalesce(F.max(F.when(out, F.col("upto"))).over(Window.partitionBy("cik", "fiscal_year", "h")), F.lit(0.0))
    return found.withColumn("rest", rest).where(~out).select("cik", "fiscal_year", "t", "h", "block", "x", "rest")


def candidates(vectors: DataFrame, keep: Keep, floor: float = EDGE_FLOOR, most_rows: int = HOT_TERM) -> DataFrame:
    """(cik, fiscal_year, curr, prev, curr_block, prev_block): pairs that may lie above the floor, from stored vectors.

    Keys of (company, year, term) with more records than `most_rows` on a side are dealt into as many parts as it takes,
    each part of the one side meeting each of the other.
    """
    key = ["cik", "fiscal_year", "t"]
    long = vectors.select("cik", "fiscal_year", "h", "block", F.inline("terms"))
    before = vectors.select("cik", (F.col("fiscal_year") + 1).alias("fiscal_year"), F.col("h").alias("prev"), F.col("block").alias("prev_block"), F.inline("terms")).withColumnRenamed("x", "y")
    stats = keep(before.groupBy(*key).agg(F.count("*").alias("k"), F.max("y").alias("most")))
    start = keep(prefixes(long, stats, floor).withColumnsRenamed({"h": "curr", "block": "curr_block"}))
    parts = lambda c: F.ceil(F.col(c) / F.lit(most_rows)).cast("int")
    n_curr = start.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most_rows)
    n_prev = stats.where(F.col("k") > most_rows).select(*key, "k")
    hot = keep(n_curr.join(n_prev, key, "full").select(*key, F.coalesce(parts("n"), F.lit(1)).alias("curr_parts"), F.coalesce(parts("k"), F.lit(1)).alias("prev_parts")))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        side = side.join(hot, key, "left")
        mine = F.coalesce(F.pmod(F.col(own), F.col(f"{own}_parts")).cast("int"), F.lit(0)).alias(f"{own}_part")
        theirs = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"{other}_parts"), F.lit(1)) - 1)).alias(f"{other}_part")
        return side.select("*", mine, theirs).drop("curr_parts", "prev_parts")

    if hot.limit(1).count():
        met = dealt(start, "curr", "prev").join(dealt(before, "prev", "curr"), [*key, "curr_part", "prev_part"])
    else:
        met = start.join(before, key)
    pairs = met.groupBy("cik", "fiscal_year", "curr", "prev", "curr_block", "prev_block").agg(F.sum(F.col("x") * F.col("y")).alias("dot"), F.first("rest").alias("rest"))
    return pairs.where(F.col("dot") + F.col("rest") > F.lit(floor - SLACK)).drop("dot", "rest")


#: Whose, term and value of each entry of some vectors.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def _entries(table: pa.Table) -> Entries:
    """Entries of vectors (t, x) in lists."""
    lists = pa.concat_arrays(table.column("terms").chunks) if table.num_rows else pa.array([], table.schema.field("terms").type)
    whose = np.repeat(np.arange(table.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    return whose, *(pc.struct_field(lists.flatten(), c).to_numpy(zero_copy_only=False) for c in ("t", "x"))


def _unpacked(table: pa.Table, known: list[np.ndarray]) -> Entries:
    """Entries of packed vectors, each field of its share's length."""
    heads, gaps, tfs = zip(*map(unpack, table.column("terms").to_pylist()), strict=True) if table.num_rows else ([], [], [])
    if not table.num_rows:
        return np.array([], np.int64), np.array([], np.int64), np.array([])
    of_heading = np.array([x[0] for x in heads], np.int64)
    all_of = np.array([len(x) for x in gaps])
    sizes = np.stack([of_heading, all_of - of_heading], axis=1).ravel()
    term = _summed(np.concatenate(gaps), sizes)
    factor = np.sqrt([HEADING_WEIGHT, BODY_WEIGHT]) / np.array([x[1:] for x in heads], np.uint64).view(np.float64)
    x = (1 + np.log(np.concatenate(tfs).astype(np.float64) + 1)) * _idf(term, known) * np.repeat(factor.ravel(), sizes)
    return np.repeat(np.arange(table.num_rows), all_of), term, x


def block_products(now: Entries, before: Entries, height: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, products with all of `before`) of a few rows of `now` at a time, at most about `CELLS` products.

    Terms that many pairs share are multiplied as dense matrices, the others by their postings.
    """
    (i, t, x), (j, u, y) = now, before
    terms, place = np.unique(np.concatenate([t, u]), return_inverse=True)
    t, u = place[: len(t)], place[len(t) :]
    n_now, n_before = np.bincount(t, minlength=len(terms)), np.bincount(u, minlength=len(terms))
    shared = n_now * n_before
    dense = np.argsort(-shared, kind="stable")[:DENSE]
    dense = dense[shared[dense] > DENSE_SHARE * height * width]
    column = np.full(len(terms), -1)
    column[dense] = np.arange(len(dense))
    matrix = np.zeros((len(dense), width))
    of = column[u] >= 0
    np.add.at(matrix, (column[u[of]], j[of]), y[of])
    rare = (n_now[u] > 0) & ~of
    j, u, y = j[rare], u[rare], y[rare]
    order = np.argsort(u, kind="stable")
    j, y, n = j[order], y[order], np.bincount(u, minlength=len(terms))
    start = np.cumsum(n) - n
    of = column[t] >= 0
    dense_i, dense_t, dense_x = i[of], column[t[of]], x[of]
    rare = (n[t] > 0) & ~of
    i, t, x = i[rare], t[rare], x[rare]
    rows = max(1, CELLS // max(width, 1))
    for first in range(0, height, rows):
        last = min(first + rows, height)
        a, b = np.searchsorted(dense_i, (first, last))
        own = np.zeros((last - first, len(dense)))
        np.add.at(own, (dense_i[a:b] - first, dense_t[a:b]), dense_x[a:b])
        a, b = np.searchsorted(i, (first, last))
        many = n[t[a:b]]
        at = np.repeat(start[t[a:b]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        cells = np.repeat((i[a:b] - first) * width, many) + j[at]
        yield first, own @ matrix + np.bincount(cells, np.repeat(x[a:b], many) * y[at], minlength=(last - first) * width).reshape(last - first, width)


def products(now: pa.Table, before: pa.Table, entries: Callable[[pa.Table], Entries]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row of `now`, first row of `before`, products), from a few records of either at a time, so that few vectors are unpacked."""
    for a in range(0, now.num_rows, SOME):
        left = now.slice(a, SOME)
        own = entries(left)
        for b in range(0, before.num_rows, SOME):
            right = before.slice(b, SOME)
            for first, s in block_products(own, entries(right), left.num_rows, right.num_rows):
                yield a + first, b, s


#: What is found among the products of two blocks: from their key, the records of both, the products and the floor.
Work = Callable[[tuple, pa.Table, pa.Table, Iterator[tuple[int, int, np.ndarray]], float], pa.Table]


def _named(key: tuple, curr: pa.Array, prev: pa.Array, sim: np.ndarray) -> pa.Table:
    same = lambda v: pa.repeat(v, len(sim))
    return pa.table({"cik": same(key[0]), "fiscal_year": same(key[1]), "curr_id": curr, "prev_id": prev, "sim": pa.array(sim, pa.float64())})


def _ids(table: pa.Table, rows: list[np.ndarray]) -> pa.Array:
    return pa.concat_arrays(table.column("risk_id").chunks).take(pa.array(np.concatenate(rows))) if rows and table.num_rows else pa.array([], pa.string())


def pairs_above(key: tuple, now: pa.Table, before: pa.Table, found: Iterator[tuple[int, int, np.ndarray]], floor: float) -> pa.Table:
    """All pairs of two blocks above the floor."""
    curr, prev, sims = [], [], []
    for a, b, s in found:
        i, j = np.nonzero(s > floor)
        curr.append(i + a)
        prev.append(j + b)
        sims.append(s[i, j].round(DIGITS))
    return _named(key, _ids(now, curr), _ids(before, prev), np.concatenate(sims) if sims else np.array([]))


def _places(of: np.ndarray, sim: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place from 0 of each pair among those of one record, by similarity, of equals the higher other first; and how many the record has."""
    order = np.lexsort((-other, -sim, of))
    n = np.bincount(of)
    place = np.empty(len(of), int)
    place[order] = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return place, n[of]


def top_pairs(key: tuple, now: pa.Table, before: pa.Table, found: Iterator[tuple[int, int, np.ndarray]], floor: float, most: int) -> pa.Table:
    """Pairs of two blocks above the floor that are among the first `most` of either record; `curr_top` and `prev_top` tell that they are among the first of a record that has more."""
    curr, prev, sims = [np.array([], int)], [np.array([], int)], [np.array([])]
    for a, b, s in found:
        i, j = np.nonzero(s > floor)
        curr.append(i + a)
        prev.append(j + b)
        sims.append(s[i, j].round(DIGITS))
    i, j, sim = np.concatenate(curr), np.concatenate(prev), np.concatenate(sims)
    (a, n), (b, m) = _places(i, sim, j), _places(j, sim, i)
    stay = (a < most) | (b < most)
    out = _named(key, _ids(now, [i[stay]]), _ids(before, [j[stay]]), sim[stay])
    for name, place, of in (("curr_top", a, n), ("prev_top", b, m)):
        out = out.append_column(name, pa.array(((place < most) & (of > most))[stay]))
    return out


def best_pairs(key: tuple, now: pa.Table, before: pa.Table, found: Iterator[tuple[int, int, np.ndarray]], floor: float) -> pa.Table:
    """The best pair above the floor of each record of two blocks, which are in order of their ids; of equals, that with the higher id on the other side."""
    top_now, of_now = np.full(now.num_rows, -1.0), np.zeros(now.num_rows, int)
    top, whose = np.full(before.num_rows, -1.0), np.zeros(before.num_rows, int)
    for a, b, s in found:
        s = s.round(DIGITS)
        j = s.shape[1] - 1 - s[:, ::-1].argmax(axis=1)
        of_row = s[np.arange(len(s)), j]
        better = np.flatnonzero(of_row >= top_now[a : a + len(s)])
        top_now[a + better], of_now[a + better] = of_row[better], j[better] + b
        i = len(s) - 1 - s[::-1].argmax(axis=0)
        of_column = s[i, np.arange(s.shape[1])]
        better = np.flatnonzero(of_column >= top[b : b + s.shape[1]])
        top[b + better], whose[b + better] = of_column[better], i[better] + a
    mine, theirs = np.flatnonzero(top_now > floor), np.flatnonzero(top > floor)
    return _named(key, _ids(now, [mine, whose[theirs]]), _ids(before, [of_now[mine], theirs]), np.concatenate([top_now[mine], top[theirs]]))


def counted(key: tuple, now: pa.Table, before: pa.Table, found: Iterator[tuple[int, int, np.ndarray]], floor: float) -> pa.Table:
    """How many pairs above the floor have each similarity, rounded half up to 4 decimals, of two blocks."""
    n = np.zeros(1, np.int64)
    for _, _, s in found:
        own = np.bincount(((s[s > floor].round(DIGITS) * 10.0**DIGITS).round().astype(np.int64) + 5 * 10 ** (DIGITS - 5)) // 10 ** (DIGITS - 4))
        n, own = (np.pad(x, (0, max(len(n), len(own)) - len(x))) for x in (n, own))
        n += own
    at = np.flatnonzero(n)
    return pa.table({"similarity": at / 1e4, "n": n[at]})


PAIRS = "curr_id string, prev_id string, sim double"


def by_blocks(now: DataFrame, before: DataFrame, work: Work, floor: float, most_rows: int, gives: str | None = None) -> DataFrame:
    """(cik, fiscal_year, curr_id, prev_id, sim), or what else `gives` says: what `work` finds among blocks of records and blocks of the year before, from stored vectors.

    A company's year falls into blocks of at most about `most_rows` records and `MEET_BYTES`; a block goes to each block that
    it meets, and nothing of a pair leaves the task but what is found.
    """
    year = ["cik", "fiscal_year"]
    packed = isinstance(now.schema["terms"].dataType, BinaryType)
    entries = _entries
    if packed:
        known = [unpack(bytes(x.terms)) for x in now.where("cik IS NULL AND risk_id IS NULL").select("terms").collect()]
        entries = partial(_unpacked, known=known[0] if known else [])
    before = before.withColumn("fiscal_year", F.col("fiscal_year") + 1)
    blocks = F.count("*") / F.lit(most_rows)
    blocks = F.ceil(F.greatest(blocks, F.sum(F.octet_length("terms")) / F.lit(MEET_BYTES)) if packed else blocks).cast("int")
    sizes = lambda side, name: side.groupBy(*year).agg(blocks.alias(name))
    both = sizes(now, "n_curr").join(sizes(before, "n_prev"), year)
    # Numbers of blocks go to the vectors, which else would be shuffled for them alone.
    both = F.broadcast(both) if both.count() <= FEW_YEARS else both
    columns = ["risk_id", "terms"]
    mine = lambda n: F.pmod(F.shiftright("h", 20), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at = [*year, "curr_block", "prev_block"]
    left = now.drop("block").join(both, year).select(*year, mine("n_curr").alias("curr_block"), each("n_prev").alias("prev_block"), *columns)
    right = before.drop("block").join(both.toDF(*both.columns), year).select(*year, each("n_curr").alias("curr_block"), mine("n_prev").alias("prev_block"), *columns)
    kinds = ", ".join(f"{c} {now.schema[c].dataType.simpleString()}" for c in year)

    def found(key, left, right):
        left, right = (x.select(columns).sort_by("risk_id") for x in (left, right))
        return work(key, left, right, products(left, right, entries), floor)

    return left.groupBy(*at).cogroup(right.toDF(*right.columns).groupBy(*at)).applyInArrow(found, gives or f"{kinds}, {PAIRS}")


def edges_of(whole: DataFrame, floor: float = EDGE_FLOOR, most_rows: int = MEET) -> DataFrame:
    """`edges` from stored whole vectors."""
    return by_blocks(whole, whole, pairs_above, floor, most_rows)


def top_edges_of(whole: DataFrame, floor: float, most: int, most_rows: int = MEET) -> DataFrame:
    """Of `edges_of`, those among the first `most` of either record in the blocks where they meet, with `curr_top` and `prev_top`: their number grows with that of records."""
    kinds = ", ".join(f"{c} {whole.schema[c].dataType.simpleString()}" for c in ("cik", "fiscal_year"))
    return by_blocks(whole, whole, partial(top_pairs, most=most), floor, most_rows, f"{kinds}, {PAIRS}, curr_top boolean, prev_top boolean")


def similarities_of(whole: DataFrame, floor: float = EDGE_FLOOR, most_rows: int = MEET) -> DataFrame:
    """(similarity, n): similarities of `edges_of` to 4 decimals, and how many edges have them; several rows may have one similarity. No edge leaves the task that finds it."""
    return by_blocks(whole, whole, counted, floor, most_rows, "similarity double, n bigint")


def nearest(now: DataFrame, before: DataFrame, floor: float = EDGE_FLOOR, most_rows: int = MEET) -> DataFrame:
    """Edges among which each record of both sides has its best one, from stored whole vectors; two at most a record and block."""
    return by_blocks(now, before, best_pairs, floor, most_rows)


def edges(weighted: DataFrame, floor: float = EDGE_FLOOR, keep: Keep = lambda df: df, most_rows: int = MEET) -> DataFrame:
    """(cik, fiscal_year, curr_id, prev_id, sim) of all pairs above the floor, from weights or unit vectors.

    Blocks of whole vectors meet, where all their products are worked out and only those above the floor are given out:
    the work is that of all pairs, what is shuffled is vectors. `keep` writes a frame and reads it back.
    """
    return edges_of(keep(whole_vectors(weighted)), floor, most_rows)
