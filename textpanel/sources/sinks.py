"""Writers: tables, exports, append-only logs, resumable appends."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter for each key (one key in 64 is taken for seen by mistake), filters that stand side by side, and their columns.
BITS, BATCHES = 64, 8
SEEN = "batch string, m long, bucket long, bits binary"


def csv_export(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header and doubled quotes. `single` gathers the rows into one file and is for exports of bounded size."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def union_of_columns(*frames: DataFrame) -> DataFrame:
    """All rows under the union of all columns, nulls where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def nested_documents(df: DataFrame, path: str, by: tuple[str, ...] = ("cik", "fiscal_year")) -> None:
    """One folder per company and year with JSON documents in it."""
    df.write.mode("overwrite").partitionBy(*by).json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key a log doesn't hold yet."""
    return df.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def seen_bits(rows: DataFrame, key: str) -> DataFrame:
    """(batch, m, bucket, bits): a Bloom filter of the keys, `BITS` bits for each, as bitmaps by bucket; null keys aren't in it."""
    m = 1 << max(15, (rows.count() * BITS).bit_length())
    at = F.pmod(F.xxhash64(key), F.lit(m)) + 1
    return rows.where(F.col(key).isNotNull()).groupBy(F.lit(uuid.uuid4().hex).alias("batch"), F.lit(m).alias("m"), F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def maybe_seen(rows: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """The distinct keys that some filter can't rule out; every key that is in one is among them."""
    sizes = [(r.batch, r.m) for r in filters.select("batch", "m").distinct().collect()]  # as many as there are batches, `BATCHES` at most
    if not sizes:
        return rows.select(key).limit(0)
    asked = F.explode(F.array(*[F.struct(F.lit(b).alias("batch"), (F.pmod(F.xxhash64(key), F.lit(m)) + 1).alias("at")) for b, m in sizes]))
    places = rows.where(F.col(key).isNotNull()).select(key, asked.alias("x")).select(key, "x.batch", F.bitmap_bucket_number("x.at").alias("bucket"), F.bitmap_bit_position("x.at").alias("nth"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("nth") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("nth") % 8)), F.lit(2)) == 1
    return places.join(filters.drop("m"), ["batch", "bucket"]).where(is_set).select(key).distinct()


def _read(spark, path: str, schema) -> DataFrame | None:
    try:
        found = spark.read.schema(schema).parquet(path)
        found.limit(1).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return found


def append_resumable(df: DataFrame, path: str, key: str) -> int:
    """Appends the rows whose key isn't in `path` yet and returns how many those were.

    Beside the log lies a filter of its keys. Rows that it rules out are new without a look at the log; only the others are
    joined with it. The filter of a batch is written before the batch, so that a run that ends between the two leaves keys
    in the filter that the log lacks, which costs a look, and never the other way round. A log without a filter is joined
    whole and gets one; several batches' filters are made one after `BATCHES`. Only this function may add to the log.
    """
    spark, beside = df.sparkSession, f"{path.rstrip('/')}-seen"
    log, filters = _read(spark, path, df.schema), _read(spark, beside, SEEN)
    if log is None:
        new = df
    elif filters is None:
        seen_bits(log.select(key), key).write.mode("overwrite").parquet(beside)
        new = not_done(df, log, key)
    else:
        maybe = maybe_seen(df, filters, key)
        sure = df.join(maybe, key, "left_anti")
        new = sure.unionByName(not_done(df.join(maybe, key, "left_semi"), log, key)) if maybe.limit(1).count() else sure
    # What is new is settled before the filter changes: a plan that reads the filter would be worked out anew after that.
    new.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path.rstrip('/')}-next")
    new = spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}-next")
    n = new.count()
    if n:
        many = filters is not None and filters.select("batch").distinct().count() >= BATCHES
        if many:
            keys = log.select(key).unionByName(new.select(key))
            fresh = f"{beside}-{uuid.uuid4().hex}"
            seen_bits(keys, key).write.parquet(fresh)
            spark.read.schema(SEEN).parquet(fresh).write.mode("overwrite").parquet(beside)
        else:
            seen_bits(new.select(key), key).write.mode("append").parquet(beside)
        new.write.mode("append").parquet(path)
    return n


def layer_table(df: DataFrame, name: str) -> None:
    """CREATE OR REPLACE TABLE AS SELECT."""
    df.write.mode("overwrite").saveAsTable(name)


def metrics_json(df: DataFrame) -> str:
    """The JSON text of a one-row frame."""
    return df.toJSON().first() if hasattr(df, "toJSON") else df.select(F.to_json(F.struct("*"))).first()[0]


def refuse_if_labelled(existing: DataFrame, columns: tuple[str, ...]) -> None:
    """Stops before labels that someone has entered would be overwritten."""
    filled = reduce(lambda a, b: a | b, [F.coalesce(F.trim(c), F.lit("")) != "" for c in columns])
    if existing.where(filled).limit(1).count():
        raise ValueError("labels are present; refusing to overwrite them")
