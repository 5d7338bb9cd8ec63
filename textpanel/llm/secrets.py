"""Secrets, and how widely each one is copied.

A scan finds spans of the base kinds and candidates of further kinds (known credential formats, long random-looking
words). Every candidate's value is hashed, and the hashes are counted over the whole corpus: in how many repositories
(here a document stands for one) and under how many owners (sources) a value occurs. A value under `WIDE` owners or more
is a copied example, and so is one of fewer owners, but more than one, that stands in `MANY` repositories or more; all
others are owner-specific and taken to be live, however often their one owner repeats them. Base spans always stay;
further candidates are added only where their value is owner-specific. Counts come back with the spans.

Hashes are counted in steps: distinct (hash, owner, repository), then per owner, then per hash, so a value that a third
of all documents hold is added up before it is brought together. The counts go back to the spans in two joins: values of
more than `HOT` repositories by (hash, slice), with as many slices as the spans need, all others by hash. Values
themselves never leave the tasks that read them.

Edge cases: a null or empty text has no spans; a null owner or repository counts as one of its own; repeated rows are
reported each; an empty table gives an empty table; other columns pass through `redact` and are ignored by `scan`.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import beside, own_name, small_batches, stored, table

WIDE, MANY = 3, 50
#: Repositories beyond which a value's spans are dealt out in slices; spans for which one more slice is opened.
HOT, PER_SLICE = 1000, 1_000_000
#: Base kinds in the order in which they are listed, then the kinds that this method adds.
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Public formats of credentials.
FORMATS = {
    "private_key": re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[^-]*(?:-----END (?:[A-Z]+ )?PRIVATE KEY-----)?"),
    "github": re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": re.compile(r"\bAIza[A-Za-z0-9_-]{35}"),
    "stripe": re.compile(r"\b[sr]k_live_[A-Za-z0-9]{16,}"),
    "jwt": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}
#: A string that each format's matches hold, for a quick look.
SIGNS = {"private_key": "PRIVATE KEY", "github": "gh", "slack": "xox", "google": "AIza", "stripe": "k_live_", "jwt": "eyJ"}
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])")
KINDS = ("assign", "access", "hex", *FORMATS, "random")
ORDER = {k: i for i, k in enumerate(KINDS)}
KEYWORD = re.compile(r"(?ai:passw|secret|token|api_?key)")


def random_looking(value: str) -> bool:
    """Digits, small and capital letters, and at least 3.5 bits a character."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.5


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), leftmost without overlaps per kind."""
    out = []
    if KEYWORD.search(text):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans: list) -> list:
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def further_spans(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Candidates of the further kinds that overlap neither a base span nor each other."""
    found = [(kind, m.start(), m.end(), m[0]) for kind, p in FORMATS.items() if SIGNS[kind] in text for m in p.finditer(text)]
    found += [("random", m.start(), m.end(), m[0]) for m in RANDOM.finditer(text) if random_looking(m[0])]
    # Spans that are taken, as begins and ends in order; none of them overlap once they are merged.
    begins, ends, out = [], [], []
    for _, s, e, _ in base:
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            begins.append(s)
            ends.append(e)
    for kind, s, e, value in sorted(found, key=lambda x: (ORDER[x[0]], x[1])):
        at = bisect.bisect_right(begins, s)
        if (at == 0 or ends[at - 1] <= s) and (at == len(begins) or e <= begins[at]):
            begins.insert(at, s)
            ends.insert(at, e)
            out.append((kind, s, e, value))
    return in_order(out)


def joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("hash", pa.string()), ("base", pa.bool_())])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(row, key, owner, n_assign, n_access, n_hex, base_sha256, digest, found): one row per document; `found` holds all candidates."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias("key"), F.col(owner).cast("string").alias("owner"), F.col(text).alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            counts, shas, digests, found = [[], [], []], [], [], []
            for body in batch.column(2).to_pylist():
                body = body or ""
                base = base_spans(body)
                more = further_spans(body, base)
                for column, k in zip(counts, KINDS, strict=False):
                    column.append(sum(s[0] == k for s in base))
                shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
                digests.append(text_digest(body) if base or more else None)
                found.append([{"kind": k, "start": s, "stop": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "base": is_base} for is_base, spans in ((True, base), (False, more)) for k, s, e, v in spans])
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(shas)), pa.int64()), batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in counts], pa.array(shas), pa.array(digests, pa.string()), pa.array(found, pa.list_(SPAN))],
                names=["row", "key", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "digest", "found"],
            )
            row += len(shas)

    return src.mapInArrow(run, f"row long, key {kind}, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, digest string, found array<struct<kind: string, start: long, stop: long, hash: string, base: boolean>>")


def text_digest(text: str) -> str:
    return f"{hashlib.md5(text.encode()).hexdigest()}{len(text)}"


def ownership(scanned: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of every candidate value in the corpus."""
    each = scanned.select(F.coalesce("owner", F.lit("")).alias("owner"), F.col("owner").isNull().alias("no_owner"), F.col("key"), F.explode("found.hash").alias("hash"))
    per_owner = each.distinct().groupBy("hash", "owner", "no_owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def judged(scanned: DataFrame, wide: int = WIDE, many: int = MANY) -> DataFrame:
    """Every span of every document that has one, with owners and repositories of its value, and `copied`: it is an example that many share."""
    spans = scanned.where(F.size("found") > 0).select("row", "digest", F.inline("found"))
    slices = max(16, -(-(scanned.agg(F.sum(F.size("found"))).first()[0] or 0) // PER_SLICE))
    owned = stored(ownership(scanned), "ownership")
    hot = owned.where(F.col("repositories") > HOT).select(F.col("hash").alias("hot_hash"), F.col("owners").alias("hot_owners"), F.col("repositories").alias("hot_repositories"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("hot_slice"))
    spans = spans.join(hot, (F.col("hash") == F.col("hot_hash")) & (F.pmod(F.xxhash64("row"), F.lit(slices)) == F.col("hot_slice")), "left")
    # Spans with a hot value are done: in the second join each has a key of its own.
    rest = owned.where(F.col("repositories") <= HOT).withColumnRenamed("hash", "of")
    spans = spans.withColumn("look_up", F.when(F.col("hot_hash").isNull(), F.col("hash")).otherwise(F.concat(F.lit("row "), F.col("row").cast("string")))).join(rest, F.col("look_up") == F.col("of"), "left")
    spans = spans.withColumns({"owners": F.coalesce("hot_owners", "owners"), "repositories": F.coalesce("hot_repositories", "repositories")}).drop("hot_hash", "hot_owners", "hot_repositories", "hot_slice", "look_up", "of")
    return spans.withColumn("copied", (F.col("owners") >= wide) | ((F.col("owners") > 1) & (F.col("repositories") >= many)))


def kind_order(kind) -> F.Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", wide: int = WIDE, many: int = MANY) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, how many of them look live or copied, and the owners and repositories of each."""
    scanned = stored(scan(docs, key, text, owner), "secrets")
    kept = judged(scanned, wide, many).where("base or not copied").withColumn("n", kind_order(F.col("kind")))
    per = kept.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "n", F.concat_ws(":", "kind", "start", "stop").alias("span"), "owners", "repositories"))).alias("all"),
        F.sum(F.when(F.col("copied"), 0).otherwise(1)).alias("n_live"),
        F.sum(F.when(F.col("copied"), 1).otherwise(0)).alias("n_copied"),
    )
    out = scanned.drop("found").join(per, "row", "left")
    counted = F.transform("all", lambda x: F.concat_ws(":", x["owners"], x["repositories"]))
    return out.select(F.col("key").alias(key), "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(F.array_join("all.span", ","), F.lit("")).alias("spans"), F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"), F.coalesce(F.array_join(counted, ","), F.lit("")).alias("owners_repositories"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", wide: int = WIDE) -> DataFrame:
    """`docs` with every owner-specific secret replaced by `<kind>`; copied examples and all other text stay.

    Spans are a function of the text, so they come back to the documents by a digest of it.
    """
    digest, spans = own_name(docs, "text_digest", "live_spans")
    scanned = stored(scan(docs, key, text, owner), "secrets")
    live = judged(scanned, wide).where("not copied").dropDuplicates(["digest", "kind", "start"])
    per = live.groupBy("digest").agg(F.collect_list(F.struct("start", "stop", "kind")).alias(spans)).withColumnRenamed("digest", digest)

    @F.pandas_udf("string")
    def without(texts, found):
        out = []
        for body, some in zip(texts, found, strict=True):
            if some is not None and body is not None:
                at, parts = 0, []
                for s in sorted(some, key=lambda s: (s["start"], -s["stop"])):
                    if s["start"] >= at:
                        parts += [body[at : s["start"]], f"<{s['kind']}>"]
                    at = max(at, s["stop"])
                body = "".join(parts) + body[at:]
            out.append(body)
        import pandas as pd

        return pd.Series(out, dtype=object)

    keyed = docs.withColumn(digest, F.concat(F.md5(F.col(text).cast("binary")), F.length(text).cast("string")))
    both = keyed.join(beside(stored(per, "live-secrets"), 400), digest, "left")
    return both.withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(without(F.col(text), F.col(spans)))).select(docs.columns)


def op8_query(spark, sf_dir):
    return secrets(table(spark, sf_dir, "documents"))
