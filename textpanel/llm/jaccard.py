"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

A document is the set of its five-word n-grams (lower-cased words; a text of one to four words is one n-gram). Documents
with equal sets are one class representative from the start. Representatives are banded: band and row counts come from
the threshold and the recall wanted. Two representatives that share a bucket of any band are a candidate pair, and every
candidate pair is compared on the full sets, once.

Where pairs meet: buckets that overlap make groups. A group whose buckets cover it well (a true class of near copies, one
that most bands bring together) is compared as one place, and in it those pairs that share a bucket. A group that is a
chain of small overlaps (texts with a common passage here and there) is compared bucket by bucket instead, a pair in its
first common bucket only. The choice is whichever compares fewer pairs, and the pairs found are the same. A place is cut
into blocks of bounded size, so that two blocks at most meet in a task; no pair is ever emitted. What comes back is one
row per representative and block: how many documents it is linked to, and the smallest representative that it reaches, so
the output grows with the documents and not with their pairs.

A class is a connected group of links. Components are found by alternating large-star and small-star steps on tables in
the shared folder. Only the texts of candidates are read a second time.

Edge cases: a null or empty text or one without words has no n-grams, no links, and is a class of its own; repeated rows
are copies of each other, linked; rows with a null id take part, and a class of nothing else has a null class id; an
empty table gives an empty table; other columns are ignored. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import beside, own_name, small_batches, stored, table

WORDS = 5
THRESHOLD = (4, 5)
RECALL = 0.9999
ROWS = 5
#: Representatives and n-grams in a block, about: two blocks at most meet in a task at once.
BLOCK, BLOCK_GRAMS = 512, 1 << 19
#: The band of a place that is a whole group of buckets.
WHOLE = -1
COLUMNS = 4096
PIECE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def bands(threshold: float = THRESHOLD[0] / THRESHOLD[1], recall: float = RECALL, rows: int = ROWS) -> int:
    """How many bands of `rows` values find a pair at the threshold with the wanted recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i from 0 to n - 1 at least."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        _powers[size] = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (BASE, INVERSE))
    return _powers[size]


def run_hashes(text: str, between: np.ndarray, begin: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of bytes that aren't `between`, in order, and of the first `begin` bytes of longer ones: polynomial sums, for all runs at once."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    whole, begun, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw):  # cut between runs; a longer run is taken whole
            spaces = np.flatnonzero(between[raw[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(between[raw[end:]])
                end = end + int(later[0]) + 1 if len(later) else len(raw)
        b = raw[at:end]
        blank = between[b]
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(len(b) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)])
        whole.append(mixed((total[last] - total[first]) * down[first]))
        if begin:
            first = first[last - first > begin]
            begun.append(mixed((total[first + begin] - total[first]) * down[first] + np.uint64(begin)))
        at = end
    return np.concatenate(whole), np.concatenate(begun)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each lower-cased word, in order."""
    return run_hashes((text or "").lower(), SPACE)[0]


def grams(text: str | None, n: int = WORDS) -> np.ndarray:
    """The n-grams' hashes, distinct and ascending."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        h = mixed(h * np.uint64(31) + w[i : len(w) - n + 1 + i] + np.uint64(i))
    return np.unique(h)


def digest(g: np.ndarray) -> str:
    return hashlib.md5(g.tobytes()).hexdigest()


def band_hashes(g: np.ndarray, n_bands: int, rows: int = ROWS) -> np.ndarray:
    r = np.random.default_rng(11)
    a = r.integers(0, 1 << 63, n_bands * rows, np.uint64) << np.uint64(1) | np.uint64(1)
    b = r.integers(0, 1 << 63, n_bands * rows, np.uint64)
    low = np.full(n_bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(g), 1 << 12):
        low = np.minimum(low, mixed_min(a, b, g[at : at + (1 << 12)]))
    low = low.reshape(n_bands, rows)
    h = np.arange(n_bands, dtype=np.uint64)
    for i in range(rows):
        h = mixed(h * np.uint64(31) + low[:, i])
    return h.view(np.int64)


def mixed_min(a: np.ndarray, b: np.ndarray, g: np.ndarray) -> np.ndarray:
    return (np.multiply.outer(a, g) + b[:, None]).min(1)


def text_sign(text: Column) -> Column:
    """What tells a text from another one without its bytes: md5 and length."""
    return F.concat(F.md5(text), F.length(text).cast("string"))


def signatures(docs: DataFrame, key: str, text: str, n_bands: int) -> DataFrame:
    """(row, key, sign, digest, n_grams, bands): a null digest where there is no word."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), text_sign(F.col(text)).alias("sign"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            made = [grams(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + len(made)), pa.int64()),
                    batch.column(0),
                    batch.column(2),
                    pa.array([digest(g) if len(g) else None for g in made], pa.string()),
                    pa.array([len(g) for g in made], pa.int64()),
                    pa.array([band_hashes(g, n_bands) if len(g) else None for g in made], pa.list_(pa.int64())),
                ],
                names=["row", "key", "sign", "digest", "n_grams", "bands"],
            )
            row += len(made)

    return src.mapInArrow(run, "row long, key long, sign string, digest string, n_grams long, bands array<long>")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that it is connected to."""
    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), name)
    state = None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or now[0] == 0:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(e.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
        state = now
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(low, F.col("b") == F.col("u")).select(F.col("m").alias("x"), F.col("a").alias("y")).union(low.select(F.col("m").alias("x"), F.col("u").alias("y")))
        e = stored(small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), name)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each set of `left` shares with each of `right`."""
    sets = left + right
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    number = np.cumsum(count > 1) - 1
    column = number[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    total = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, total, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, total - at)), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


#: A representative in a place: rep, copies, block, n-grams, band hashes.
Row = tuple[int, int, int, np.ndarray, np.ndarray]


def meet(left: np.ndarray, right: np.ndarray, band: int) -> np.ndarray:
    """Which pairs of rows of band hashes share a bucket; in the place of one band, those that share no earlier one."""
    out = np.zeros((len(left), len(right)), bool)
    for b in range(left.shape[1] if band == WHOLE else band):
        out |= left[:, b, None] == right[None, :, b]
    return out if band == WHOLE else (left[:, band, None] == right[None, :, band]) & ~out


def linked(rows: list[Row], i: int, j: int, band: int = WHOLE) -> list[tuple[int, int, int]]:
    """(rep, smallest rep reached, documents linked to) for the reps of blocks i and j of a place.

    Blocks of their own are compared within, two different ones only across, so every pair is compared once.
    """
    left = [r for r in rows if r[2] == i]
    right = left if i == j else [r for r in rows if r[2] == j]
    if not left or not right:
        return []
    meeting = meet(np.stack([r[4] for r in left]), np.stack([r[4] for r in right]), band)
    if i == j:
        np.fill_diagonal(meeting, False)
    if not meeting.any():
        return []
    a, b = np.array([len(r[3]) for r in left]), np.array([len(r[3]) for r in right])
    common = overlaps([r[3] for r in left], [r[3] for r in right])
    near = meeting & (common * THRESHOLD[1] >= (a[:, None] + b[None, :] - common) * THRESHOLD[0])
    n, m = near.shape
    reps = np.array([r[0] for r in left] + ([] if i == j else [r[0] for r in right]))
    copies_left, copies_right = (np.array([r[1] for r in side]) for side in (left, right))
    links = near @ copies_right if i == j else np.concatenate([near @ copies_right, near.T @ copies_left])
    whole = near
    if i != j:
        whole = np.zeros((n + m, n + m), bool)
        whole[:n, n:], whole[n:, :n] = near, near.T
    label = reps.copy()
    high = np.iinfo(np.int64).max
    while True:
        new = np.minimum(label, np.where(whole, label[None, :], high).min(1))
        if (new == label).all():
            break
        label = new
    return [(int(r), int(x), int(k)) for r, x, k in zip(reps, label, links, strict=True) if k]


def places(reps: DataFrame) -> DataFrame:
    """(rep, meets: [(band, place, blocks)]) of every representative that shares a bucket: where it meets the others."""
    members = reps.select("rep", "n_grams", F.posexplode("bands").alias("band", "bucket"))
    hubs = stored(members.groupBy("band", "bucket").agg(F.min("rep").alias("a"), F.count("*").alias("n"), F.sum("n_grams").alias("grams"), F.bit_xor(F.xxhash64("rep")).alias("who")).where("n > 1"), "buckets")
    shared = stored(members.drop("n_grams").join(hubs.drop("who"), ["band", "bucket"]), "bucket-members")
    group = stored(components(shared.select("a", F.col("rep").alias("b")), "candidates"), "candidate-groups")
    by_bucket = hubs.join(group, F.col("a") == F.col("node")).groupBy("root").agg(F.sum(F.col("n") * F.col("n")).alias("in_buckets"))
    sized = group.join(reps.select(F.col("rep").alias("node"), "n_grams"), "node").groupBy("root").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams"))
    chosen = stored(sized.join(by_bucket, "root").select("root", F.when(F.col("n") * F.col("n") <= F.col("in_buckets"), blocks_of(F.col("n"), F.col("grams"))).alias("whole")), "groups")
    of_group = group.join(chosen, "root")
    whole = of_group.where("whole is not null").select(F.col("node").alias("rep"), F.lit(WHOLE).alias("band"), F.col("root").alias("place"), F.col("whole").alias("blocks"))
    chains = shared.join(of_group.where("whole is null").select(F.col("node").alias("rep")), "rep")
    # A bucket with the same members as one of an earlier band has no pair of its own.
    own = hubs.groupBy("n", "a", "who").agg(F.min(F.struct("band", "bucket")).alias("first")).select("first.band", "first.bucket")
    single = chains.select("rep", "band", "bucket", "n", "grams").join(own, ["band", "bucket"]).select("rep", "band", F.col("bucket").alias("place"), blocks_of(F.col("n"), F.col("grams")).alias("blocks"))
    # A representative has one place of a whole group, or one for each band at most.
    return whole.unionByName(single).groupBy("rep").agg(F.collect_list(F.struct("band", "place", "blocks")).alias("meets"))


def blocks_of(n: Column, grams: Column) -> Column:
    return F.ceil(F.greatest(n / BLOCK, grams / BLOCK_GRAMS)).cast("int")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """Per row: row (any distinct number), key, set_id, class_id (smallest keys of its equal sets and of its class), n_links, n_grams, digest, root (the same number in all rows of a class), sign (of the text)."""
    n_bands = bands(recall=recall)
    signed = stored(signatures(docs, key, text, n_bands), "signatures")
    reps = stored(signed.where("digest is not null").groupBy("digest").agg(F.min("row").alias("rep"), F.min("key").alias("set_id"), F.count("*").alias("copies"), F.min_by(F.struct("key", "sign", "bands", "n_grams"), "row").alias("of")).select("digest", "rep", "set_id", "copies", F.col("of.key").alias("rep_key"), F.col("of.sign").alias("rep_sign"), F.col("of.n_grams").alias("n_grams"), F.col("of.bands").alias("bands")), "representatives")
    wanted = stored(reps.select("rep", "rep_key", "rep_sign", "digest", "copies", "bands").join(places(reps), "rep"), "wanted")
    sets = stored(gram_sets(docs, wanted, key, text), "gram-sets")
    # In each of its places a block meets every other block once, under the key (band, place, lower block, higher block).
    there = sets.select("rep", "copies", "grams", "bands", F.inline("meets")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int"))
    met = there.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", "place", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "copies", "own", "grams", "bands")
    checked = stored(compare(met), "links")
    per_rep = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("rep").alias("a"), F.col("reached").alias("b")), "links-groups")
    known = reps.select("digest", "rep", "set_id", "copies").join(per_rep, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    known = stored(known, "classes")
    smallest = known.groupBy("root").agg(F.min("set_id").alias("class_id"))
    by_digest = known.join(smallest, "root").select("digest", "root", "set_id", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = signed.drop("bands").join(by_digest, "digest", "left")
    return out.select("row", F.col("key").alias(key), F.coalesce("set_id", "key").alias("set_id"), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_grams", "digest", F.coalesce("root", "row").alias("root"), "sign")


def gram_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The n-gram sets of the wanted representatives, from their texts: a text meets the one of its id and sign only.

    They meet by shuffle at every size: the wanted rows grow with the documents.
    """
    small_batches(docs.sparkSession)
    kept = ["rep", "copies", "bands", "meets"]
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(wanted.hint("merge"), F.col("key").eqNullSafe(F.col("rep_key")) & (text_sign(F.col("text")) == F.col("rep_sign"))).select("text", "digest", *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[int] = set()
        for batch in batches:
            at, sets = [], []
            for i, (body, sign, rep) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                if rep in made:
                    continue
                g = grams(body)
                if len(g) and digest(g) == sign:
                    made.add(rep)
                    at.append(i)
                    sets.append(g.tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(pa.array(at, pa.int64())) for i in range(2, 6)], pa.array(sets, pa.binary())], names=[*kept, "grams"])

    # A text that an id has several times gives its set once per task; `compare` holds one set of each.
    return src.mapInArrow(run, "rep long, copies long, bands array<long>, meets array<struct<band: int, place: long, blocks: int>>, grams binary")


def compare(met: DataFrame) -> DataFrame:
    """(rep, reached, links) of each pair of blocks: rows of one (band, place, i, j) meet in order of that key, so a task holds one pair of blocks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Row] = {}
        current, out = None, []

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], names=["rep", "reached", "links"])
            out.clear()
            return batch

        for batch in batches:
            band, place, i, j, rep, copies, own = (batch.column(k).to_pylist() for k in range(7))
            bands = batch.column(8).flatten().to_numpy().reshape(batch.num_rows, -1)
            for at, g in enumerate(batch.column(7)):
                group = (band[at], place[at], i[at], j[at])
                if group != current:
                    if current:
                        out += linked(list(held.values()), current[2], current[3], current[0])
                    held.clear()
                    current = group
                held[rep[at]] = (rep[at], copies[at], own[at], np.frombuffer(g.as_py(), np.uint64), bands[at])
            if len(out) > 10_000:
                yield made()
        if current:
            out += linked(list(held.values()), current[2], current[3], current[0])
        yield made()

    key = ["band", "place", "i", "j"]
    return met.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "rep long, reached long, links long")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """`docs` with one row of each class: of the smallest id (null before all others), then of the smallest text sign.

    Rows come back by id and text sign, so that an id may have rows of several classes; of rows with one id and one text,
    which are of one class, the one whose other columns come first as JSON stays.
    """
    known = jaccard_join(docs, key, text, recall).where("digest is not null").select(F.col(key).alias("gone_key"), F.col("sign").alias("gone_sign"), "root")
    texts = stored(known.groupBy("gone_key", "gone_sign").agg(F.min("root").alias("root"), F.count("*").alias("n")), "kept")
    first = texts.groupBy("root").agg(F.min(F.struct("gone_key", "gone_sign")).alias("first")).select(F.col("first.gone_key").alias("keep_key"), F.col("first.gone_sign").alias("keep_sign"))
    less = texts.join(first, F.col("gone_key").eqNullSafe(F.col("keep_key")) & (F.col("gone_sign") == F.col("keep_sign")), "left").withColumn("one_stays", F.col("keep_sign").isNotNull()).where("n > 1 or not one_stays")
    gone = stored(less.select("gone_key", "gone_sign", "one_stays"), "gone")
    of, sign, one_stays, kept = own_name(docs, "gone_key", "gone_sign", "one_stays", "kept")
    both = docs.join(beside(gone.toDF(of, sign, one_stays), 80), F.col(key).cast("long").eqNullSafe(F.col(of)) & (text_sign(F.col(text)) == F.col(sign)), "left")
    out = both.where(F.col(one_stays).isNull()).select(docs.columns)
    if gone.where("one_stays").limit(1).count():
        others = F.to_json(F.struct(*[c for c in docs.columns if c != text]))
        some = both.where(F.col(one_stays)).groupBy(of, sign).agg(F.min_by(F.struct(*docs.columns), others).alias(kept))
        out = out.unionByName(some.select(f"{kept}.*"))
    return out


def op2_query(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "set_id", "class_id", "n_links", "n_grams")
