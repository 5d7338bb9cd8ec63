"""Year-over-year matching: mutual best with a margin, in rounds, then labels.

A round looks at all companies at once. The first one ranks all edges, the others only those of records that have lost a
neighbour in the round before; what a round accepts is written out, so that plans don't grow.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpanel.constants import BANDS, MATCH_MARGIN, MATCH_MIN, PERCENTILES, REVIEW_BAND, REWRITE_CHURN, REWRITE_COUNT, REWRITE_LENGTH, UNCHANGED_MIN
from textpanel.functions.ranks import at_places
from textpanel.operators.sampling import luck

#: Writes a frame and gives it back as it is read again.
Keep = Callable[[DataFrame], DataFrame]
#: Rounds whose pairs are tables of their own, so that plans stay small.
GATHER = 16
#: Rows of ids, of up to some sixty bytes, that are broadcast.
BROADCAST_ROWS = 100_000
#: Edges that decide about pairs, labels and reviews: below, one is neither accepted nor a runner-up too close nor in need of a review.
DECIDING = min(MATCH_MIN - MATCH_MARGIN, REVIEW_BAND[0]) - 0.001
#: A record's first edges that rounds begin with.
FIRST_EDGES = 8
#: Edges that a round ranks anew.
FEW_EDGES = 1_000_000


def best(open_edges: DataFrame, side: str) -> DataFrame:
    """The best edge of each record on one side, with the runner-up's similarity (0 without one); of equals, that with the higher id on the other side."""
    other = "prev" if side == "curr" else "curr"
    w = Window.partitionBy(f"{side}_id").orderBy(F.desc("sim"), F.desc(f"{other}_id"))
    ranked = open_edges.withColumns({"nth": F.row_number().over(w), f"{side}_next": F.coalesce(F.lead("sim").over(w), F.lit(0.0))})
    return ranked.where("nth = 1").drop("nth")


def clear(side: str) -> Column:
    """Whether a record's best edge is good enough and far enough ahead of its second."""
    return (F.col("sim") >= MATCH_MIN) & (F.col("sim") - F.col(f"{side}_next") >= MATCH_MARGIN)


def accepted(open_edges: DataFrame) -> DataFrame:
    """The pairs of one round: edges that are the best ones of both their records, and clearly so."""
    out = open_edges
    for side, other in (("curr", "prev"), ("prev", "curr")):
        w = Window.partitionBy(f"{side}_id").orderBy(F.desc("sim"), F.desc(f"{other}_id"))
        out = out.withColumns({f"{side}_rank": F.row_number().over(w), f"{side}_next": F.coalesce(F.lead("sim").over(w), F.lit(0.0))})
    return out.where((F.col("curr_rank") == 1) & (F.col("prev_rank") == 1) & clear("curr") & clear("prev")).select("cik", "fiscal_year", "curr_id", "prev_id", "sim")


def without(open_edges: DataFrame, pairs: DataFrame) -> DataFrame:
    return open_edges.join(pairs.select("curr_id"), "curr_id", "left_anti").join(pairs.select("prev_id"), "prev_id", "left_anti")


def small(df: DataFrame) -> DataFrame:
    """`df`, a kept table of ids, as a side that is broadcast while its rows are few, else joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def accepted_next(edges: DataFrame, last: DataFrame, gone: DataFrame, keep: Keep) -> DataFrame:
    """The pairs of the round after `last`, where `gone` holds all pairs so far.

    Only a record that has lost a neighbour can have another best edge or a weaker runner-up than before, so only edges that
    are best for such a record are looked at, and their other ends are ranked for them alone. What is kept on the way is as
    large as what changed.
    """
    still, last = without(edges, small(gone)), small(last)
    side = lambda name, ids: edges.join(ids, "prev_id" if name == "curr" else "curr_id", "left_semi").select(F.lit(name).alias("side"), F.col(f"{name}_id").alias("id"))
    touched = keep(side("curr", last.select("prev_id")).unionByName(side("prev", last.select("curr_id"))).distinct())
    few = small(touched)
    of = lambda name, ids: best(still.join(ids, f"{name}_id", "left_semi"), name).where(clear(name))
    columns = ["cik", "fiscal_year", "curr_id", "prev_id", "sim"]
    firsts = [of(name, few.where(F.col("side") == name).select(F.col("id").alias(f"{name}_id"))).select(columns) for name in ("curr", "prev")]
    wanted = small(keep(firsts[0].unionByName(firsts[1]).distinct()))
    ends = [of(name, wanted.select(f"{name}_id")).select("curr_id", "prev_id") for name in ("curr", "prev")]
    return wanted.join(ends[0], ["curr_id", "prev_id"], "left_semi").join(ends[1], ["curr_id", "prev_id"], "left_semi")


def match_rounds(edges: DataFrame, keep: Keep, gather: int = GATHER, few: int = FEW_EDGES) -> tuple[DataFrame, DataFrame]:
    """(pairs, edges that are still open) when a round accepts nothing more.

    Edges are written once; after the first round, a round looks at what the one before has changed and writes that. Where
    there are few edges, a round ranks all that are open, which then takes less time. Every other round takes a pair away,
    so the rounds end; pairs are gathered in one table every `gather` rounds.
    """
    edges = keep(edges)
    rest, all_anew = edges, edges.count() <= few
    pairs, parts = keep(accepted(edges)), []
    while pairs.limit(1).count():
        parts.append(pairs)
        if len(parts) >= gather:
            parts = [keep(reduce(DataFrame.unionByName, parts))]
        if all_anew:
            rest = keep(without(rest, pairs))
            pairs = keep(accepted(rest))
        else:
            pairs = keep(accepted_next(edges, pairs, reduce(DataFrame.unionByName, parts), keep))
    found = reduce(DataFrame.unionByName, parts or [pairs])
    return found, rest if all_anew else keep(without(edges, found))


def cut_short(top: DataFrame, pairs: DataFrame, most: int) -> bool:
    """Whether a record that has more edges than its first `most` may have lost so many of these to other pairs that its best two were no longer among them."""
    lost = []
    for side, other in (("curr", "prev"), ("prev", "curr")):
        taken = small(pairs.select(F.col(f"{other}_id"), F.col(f"{side}_id").alias("by")))
        own = top.where(f"{side}_top").join(taken, f"{other}_id").where(F.col("by") != F.col(f"{side}_id"))
        lost.append(own.groupBy(f"{side}_id").agg(F.count("*").alias("n")).where(F.col("n") > most - 2).select("n"))
    return bool(lost[0].unionByName(lost[1]).limit(1).count())


def match_rounds_of_top(top: DataFrame, every: Callable[[], DataFrame], keep: Keep, most: int) -> tuple[DataFrame, DataFrame]:
    """`match_rounds` from `top`, edges among the first `most` of either record, as `similarity.top_edges_of` gives them.

    A round looks at a record's best two open edges, which are in `top` for as long as at least two of the record's first ones
    are open. Where that can't be told, the rounds begin anew with `every` edge.
    """
    found, rest = match_rounds(top.select("cik", "fiscal_year", "curr_id", "prev_id", "sim"), keep)
    return match_rounds(every(), keep) if cut_short(top, found, most) else (found, rest)


def label_of(similarity: Column, curr: Column, prev: Column, ambiguous: Column) -> Column:
    return F.when(ambiguous, "AMBIGUOUS").when(prev.isNull(), "NEW").when(curr.isNull(), "DROPPED").when(similarity >= UNCHANGED_MIN, "CARRIED_FORWARD").otherwise("MATERIALLY_REVISED")


def rows(records: DataFrame, pairs: DataFrame, rest: DataFrame) -> DataFrame:
    """One row per pair and per record without a counterpart, with label, review flag and the best candidate that was refused.

    Only company-years whose year before is in the panel have rows; a record that has gone stands in the year after its own.
    """
    years = records.select("cik", "fiscal_year").distinct()
    compared = years.join(years.select("cik", (F.col("fiscal_year") + 1).alias("fiscal_year")), ["cik", "fiscal_year"])
    matched = pairs.select("cik", "fiscal_year", "curr_id", "prev_id", F.round("sim", 4).alias("similarity"), F.lit(False).alias("ambiguous"), F.lit(None).cast("string").alias("rejected_id"))

    def alone(side: str, other: str, shift: int) -> DataFrame:
        own = records.select("cik", (F.col("fiscal_year") + shift).alias("fiscal_year"), F.col("risk_id").alias(f"{side}_id")).join(compared, ["cik", "fiscal_year"], "left_semi")
        best = rest.groupBy(f"{side}_id").agg(F.max(F.struct("sim", f"{other}_id")).alias("best"))
        left = own.join(pairs.select(f"{side}_id"), f"{side}_id", "left_anti").join(best, f"{side}_id", "left")
        sim = F.coalesce("best.sim", F.lit(0.0))
        return left.select("cik", "fiscal_year", *[F.col(c) if c == f"{side}_id" else F.lit(None).cast("string").alias(c) for c in ("curr_id", "prev_id")], F.round(sim, 4).alias("similarity"), (sim >= MATCH_MIN).alias("ambiguous"), F.col(f"best.{other}_id").alias("rejected_id"))

    out = matched.unionByName(alone("curr", "prev", 0)).unionByName(alone("prev", "curr", 1))
    s = F.col("similarity")
    low, high = REVIEW_BAND
    review = F.when(((s >= low) & (s < high)) | F.col("ambiguous"), "y").otherwise("")
    return out.withColumns({"label": label_of(s, F.col("curr_id"), F.col("prev_id"), F.col("ambiguous")), "review": review})


def year_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("cik", "fiscal_year").agg(F.count("*").alias("risks"), F.sum("chars").alias("chars"))


def structural_rewrites(matches: DataFrame, totals: DataFrame) -> DataFrame:
    """Company-years that were reorganised: most records look new or dropped and their number moved, yet the text is about as long."""
    churn = matches.groupBy("cik", "fiscal_year").agg((F.sum(F.col("label").isin("NEW", "DROPPED").cast("int")) / F.count("*")).alias("churn"))
    before = totals.select("cik", (F.col("fiscal_year") + 1).alias("fiscal_year"), F.col("risks").alias("n_prev"), F.col("chars").alias("chars_prev")).where("chars_prev > 0")
    both = churn.join(totals, ["cik", "fiscal_year"]).join(before, ["cik", "fiscal_year"])
    both = both.withColumns({"length_ratio": F.col("chars") / F.col("chars_prev"), "count_ratio": F.col("risks") / F.col("n_prev")})
    flagged = (F.col("churn") >= REWRITE_CHURN) & (F.abs(F.col("length_ratio") - 1) <= REWRITE_LENGTH) & (F.abs(F.col("count_ratio") - 1) >= REWRITE_COUNT)
    return both.where(flagged).select("cik", "fiscal_year", F.round("churn", 3).alias("churn"), F.round("length_ratio", 3).alias("length_ratio"), F.round("count_ratio", 3).alias("count_ratio"), "n_prev", F.col("risks").alias("n_curr"))


def band_of(similarity: Column, bands: tuple[float, ...] = BANDS) -> Column:
    out = F.lit(None).cast("string")
    for low, high in zip(bands, bands[1:], strict=False):
        out = F.when((similarity >= low) & (similarity < high), f"{low:.2f}-{high:.2f}").otherwise(out)
    return out


def histogram(similarities: DataFrame, column: str = "similarity", times: str | None = None) -> DataFrame:
    """(band, n); `times` names a column that tells how often a row's value is there."""
    bands = F.explode(F.array(*[F.lit(f"{a:.2f}-{b:.2f}") for a, b in zip(BANDS, BANDS[1:], strict=False)]))
    grid = similarities.sparkSession.range(1).select(bands.alias("band"))
    counts = similarities.groupBy(band_of(F.col(column)).alias("band")).agg((F.sum(times) if times else F.count("*")).alias("n"))
    return grid.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def percentiles(similarities: DataFrame, column: str = "similarity", at: tuple[int, ...] = PERCENTILES, *, keep: Keep, times: str | None = None) -> DataFrame:
    """(percentile, value): the value at place int(n * q / 100) of the sorted column; ranges of values are counted first (`keep` writes a frame and reads it back). `times` names a column that tells how often a row's value is there."""
    n = similarities.agg((F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col(times))), F.lit(0)) if times else F.count(column)).alias("n"))
    places = n.select(F.explode(F.array(*[F.lit(q) for q in at])).alias("percentile"), F.col("n").alias("of")).select("percentile", F.floor(F.col("of") * F.col("percentile") / 100).alias("place"))
    return at_places(similarities, column, places, keep, times=times).select("percentile", "value")


def audit_sample(matches: DataFrame, n: int, seed: str = "audit") -> DataFrame:
    """About n rows spread over bands of accepted pairs and bands of refused candidates, in random order.

    A refused pair may stand in two rows, of the new and of the dropped record; the row of the new one stays.
    """
    kind = F.when(F.col("curr_id").isNotNull() & F.col("prev_id").isNotNull(), "accepted").otherwise("rejected")
    base = matches.withColumns({"kind": kind, "a": F.coalesce("curr_id", "rejected_id"), "b": F.coalesce("prev_id", "rejected_id")}).where("a is not null and b is not null")
    once = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.col("curr_id").isNull(), F.col("prev_id").isNull()))
    base = base.withColumn("nth", once).where("nth = 1").withColumn("band", band_of(F.col("similarity")))
    pair = F.concat_ws("|", "a", "b")
    nth = F.row_number().over(Window.partitionBy("kind", "band").orderBy(luck(pair, seed), "a", "b"))
    return base.withColumn("nth", nth).orderBy("nth", luck(pair, seed), "a", "b").limit(n).orderBy(luck(pair, f"{seed}-order"), "a", "b").drop("nth", "a", "b")


def band_samples(matches: DataFrame, records: DataFrame, each: int = 2, seed: str = "bands") -> DataFrame:
    """A few accepted pairs of each band, with both headings, to read when thresholds are chosen."""
    pairs = matches.where("curr_id is not null and prev_id is not null").withColumn("band", band_of(F.col("similarity"))).where("band is not null")
    pair = F.concat_ws("|", "curr_id", "prev_id")
    nth = F.row_number().over(Window.partitionBy("band").orderBy(luck(pair, seed), "curr_id"))
    some = pairs.withColumn("nth", nth).where(F.col("nth") <= each).select("band", "nth", "curr_id", "prev_id", "similarity")
    heading = records.select("risk_id", F.substring("heading", 1, 150).alias("text"))
    out = some.join(heading.toDF("curr_id", "after"), "curr_id").join(heading.toDF("prev_id", "before"), "prev_id")
    return out.select("band", "nth", "curr_id", "prev_id", "similarity", "before", "after").orderBy(F.desc("band"), "nth")
