"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; every document of the source then expects target / source size copies.
The expected copies are summed along a fixed order of the source's documents, one random offset per source is added,
and a document is emitted once for each whole number that its stretch of the sum crosses. The order sorts documents
by size (in classes of about a tenth), so that the words taken come out close to the target, and by id within a class.

Sums are kept in whole units of 2^-24 copies, which makes them exact: neither the order of addition nor a rerun after
a lost executor changes a result. The running sum needs no task that sees a whole source: rows are numbered within
(source, size class, slice by a hash), and the slices' totals, a few thousand rows a source whatever the input, are summed
beforehand.

Edge cases: a null or empty text has size 0, expects copies as any other, and takes 0 words; a source without words
has target 0 and no copies; a null source is a source of its own, the last; repeated rows count each on their own;
an empty table gives an empty table. Helper columns avoid the names that the caller's table has; the outputs are named
by `names`, and columns that have these names already are replaced, so that a caller who wants to keep them gives others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.llm.common import WORD, own_name, stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Slices of rows within a size class, by a hash of id and size.
SLICES = 64
OUTPUTS = ("size", "source_size", "target", "copies")
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def size_class(size: Column) -> Column:
    """Digits of the size, then its first two digits: about ten percent apart, and exact in any engine."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.rpad(F.substring(digits, 1, 2), 2, "0").cast("int")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """For rows (source, source_size): each source's target.

    Sources by code point, null last, get the weights in turn. All targets add up to `share` of all sizes; none is
    above `most` times its source's size, what is over goes to the others by weight. That is a water level: with the
    sources in order of size over weight, the first few are full, and the rest share what is left by weight.
    One row per source is all that this sees.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    df = sizes.withColumn("w", w)
    full = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    df = df.withColumns(
        {
            "left": F.lit(share) * F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
            "open": F.sum("w").over(full.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    # The level that would hold if this source were the first that isn't full. It rises as long as that source is full
    # after all and falls from then on, so the highest is the true one.
    level = F.max(F.col("left") / F.col("open")).over(whole)
    return df.withColumn("target", F.least(F.col("w") * level, F.lit(float(most)) * F.col("source_size"))).select("source", "source_size", "target")


def expected(target: Column, source_size: Column) -> Column:
    """Copies that each document of a source expects, in units."""
    return F.when(source_size > 0, F.floor(target / source_size * UNIT)).otherwise(0).cast("long")


def offset(source: Column, seed: str) -> Column:
    """One random start per source, from 0 to below one copy."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\u0001")))), 1, 6), 16, 10).cast("long")


def slice_of(key: Column, size: Column) -> Column:
    """A slice by a hash that any engine has; null ids are spread by size."""
    seed = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(seed), 1, 4), 16, 10).cast("int"), F.lit(SLICES)).cast("int")


def cell_of(cls: Column, part: Column, source: Column) -> Column:
    """One name for size class, slice and source; a null source is told from any text."""
    return F.concat_ws("/", cls.cast("string"), part.cast("string"), F.when(source.isNull(), "null").otherwise(F.concat(F.lit("="), source.cast("string"))))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: str = "mix-1", size: Column | None = None, store: bool = True, names: tuple[str, str, str, str] = OUTPUTS) -> DataFrame:
    """`docs` with size, source_size, target and the number of copies that the mix takes, under `names`.

    The words are counted once: only key, source and size are kept for the totals, in the shared folder.
    """
    words, total, target, copies = names
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    cls, part, cell, at, unit, of, nth = own_name(docs.withColumns({n: F.lit(0) for n in names}), "size_class", "slice", "cell", "at", "unit", "of_cell", "nth")
    df = docs.withColumn(words, size if size is not None else word_count(F.col(text)))
    df = df.withColumns({cls: size_class(F.col(words)), part: slice_of(F.col(key), F.col(words))}).withColumn(cell, cell_of(F.col(cls), F.col(part), F.col(source)))
    if store:
        df = stored(df, "mix")
    slices = stored(df.groupBy(F.col(source).alias("source"), F.col(cls).alias("cls"), F.col(part).alias("part")).agg(F.count("*").alias("rows"), F.sum(words).alias("words")), "mix-slices")
    sizes = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    per = targets(sizes).withColumn(unit, expected(F.col("target"), F.col("source_size"))).withColumnRenamed("source", "target_of")
    ahead = Window.partitionBy("source").orderBy("cls", "part").rowsBetween(Window.unboundedPreceding, -1)
    known = slices.join(per, F.col("source").eqNullSafe(F.col("target_of"))).select(cell_of(F.col("cls"), F.col("part"), F.col("source")).alias(of), F.col("source_size").alias(total), F.col("target").alias(target), unit, F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias(at))
    # One shuffle by cell serves the join and the numbering, at every size.
    joined = df.join(stored(known, "mix-known").hint("merge"), F.col(cell) == F.col(of))
    row = F.row_number().over(Window.partitionBy(cell).orderBy(F.col(key).asc_nulls_first()))
    begin = offset(F.col(source), seed)
    upto = lambda n: F.shiftright((F.col(at) + n) * F.col(unit) + begin, 24)
    return joined.withColumn(nth, row).withColumn(copies, upto(F.col(nth)) - upto(F.col(nth) - 1)).drop(cls, part, cell, of, at, unit, nth)


def repeat_rows(mixed: DataFrame, copies: str = "copies", copy: str = "copy") -> DataFrame:
    """The mix itself: each row as many times as it is taken, `copy` counting from 0 (in place of a column of that name)."""
    return mixed.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(0), (F.col(copies) - 1).cast("int"))))


def op4_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text").withColumn("size", word_count(F.col("text"))).select("doc_id", "source", F.col("size").alias("words"))
    mixed = mix(docs, size=F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(w * max(level) OVER (), 2.0::DOUBLE * source_size) AS target FROM l),
u AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS unit,
             CAST('0x' || substr(md5('mix-1' || coalesce(source, chr(1))), 1, 6) AS BIGINT) AS start FROM t),
n AS (SELECT d.doc_id, d.size, u.source_size, u.target, u.unit, u.start,
             row_number() OVER (PARTITION BY d.source ORDER BY length(CAST(size AS VARCHAR)) * 100 + CAST(rpad(substr(CAST(size AS VARCHAR), 1, 2), 2, '0') AS INT), CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.size), 1, 4) AS INT) % 64, d.doc_id NULLS FIRST) AS nth
      FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, CAST(size * ((nth * unit + start) // 16777216 - ((nth - 1) * unit + start) // 16777216) AS BIGINT) AS taken FROM n
"""
