import math
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from textpanel.operators import matching, similarity
from textpanel.plans.records import written


def keep(df):
    return written(df, f"test-{uuid.uuid4().hex[:6]}")


def panel(spark, rows):
    df = spark.createDataFrame(rows, "risk_id string, cik int, fiscal_year int, heading string, body string")
    return df.withColumn("chars", F.length("heading") + F.length("body"))


def run(spark, rows):
    r = panel(spark, rows)
    pairs, rest = matching.match_rounds(similarity.edges(similarity.vectors(r)), keep)
    return {(x.curr_id, x.prev_id): x for x in matching.rows(r, pairs, rest).collect()}


def brute(rows):
    """The matching in plain Python, over dictionaries."""

    def grams(t):
        w = re.findall("[a-z]+", t.lower())
        return w + [f"{a}_{b}" for a, b in zip(w, w[1:], strict=False)]

    vec = {}
    for field in (3, 4):
        docs = {r[0]: grams(r[field]) for r in rows}
        df = {}
        for d in docs.values():
            for t in set(d):
                df[t] = df.get(t, 0) + 1
        for k, d in docs.items():
            w = {t: (1 + math.log(d.count(t))) * (math.log((len(docs) + 1) / (df[t] + 1)) + 1) for t in set(d)}
            n = math.sqrt(sum(x * x for x in w.values())) or 1
            vec[k, field] = {t: x / n for t, x in w.items()}
    cos = lambda a, b, f: sum(x * vec[b, f].get(t, 0) for t, x in vec[a, f].items())
    out = {}
    for cik in {r[1] for r in rows}:
        for fy in {r[2] for r in rows if r[1] == cik}:
            now, old = ([r[0] for r in rows if (r[1], r[2]) == (cik, y)] for y in (fy, fy - 1))
            if not old:
                continue
            sim = {(a, b): s for a in now for b in old if (s := 0.7 * cos(a, b, 3) + 0.3 * cos(a, b, 4)) > 0.03}
            while True:
                took = []
                for a in now:
                    rank = sorted(((sim.get((a, b), 0), b) for b in old), reverse=True)
                    if not rank or rank[0][0] < 0.25:
                        continue
                    s, b = rank[0]
                    back = sorted(((sim.get((x, b), 0), x) for x in now), reverse=True)
                    if back[0][1] == a and s - (rank[1][0] if len(rank) > 1 else 0) >= 0.05 and s - (back[1][0] if len(back) > 1 else 0) >= 0.05:
                        took.append((a, b, s))
                if not took:
                    break
                for a, b, s in took:
                    now.remove(a)
                    old.remove(b)
                    out[a, b] = "CARRIED_FORWARD" if round(s, 4) >= 0.9 else "MATERIALLY_REVISED"
            for a in now:
                out[a, None] = "AMBIGUOUS" if max((sim.get((a, b), 0) for b in old), default=0) >= 0.25 else "NEW"
            for b in old:
                out[None, b] = "AMBIGUOUS" if max((sim.get((a, b), 0) for a in now), default=0) >= 0.25 else "DROPPED"
    return out


def rounds_panel():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()
    rows = []
    for cik in range(1, 5):
        for year in (2021, 2022, 2023):
            for i in range(6):
                pick = [words[(cik * 3 + i * k + (year - 2021) * (i % 3)) % 12] for k in (1, 2, 3, 5)]
                rows.append((f"{cik}_{year}_{i}", cik, year, " ".join(pick[:3]), " ".join(pick * 2) + f" company {i}"))
    return rows


def test_matches_plain_python(spark):
    rows = rounds_panel()
    assert {k: r.label for k, r in run(spark, rows).items()} == brute(rows)


def test_identical_heading_is_never_new(spark):
    filler = [(f"f{i}", 9, 2021, f"filler number{chr(97 + i)} thing", "words of no use") for i in range(8)]
    rows = [("a", 1, 2021, "Government supervision of lending", "old words entirely"), ("b", 1, 2022, "Government supervision of lending", "fresh phrases instead"), *filler]
    got = run(spark, rows)
    assert got["b", "a"].similarity >= 0.7 and got["b", "a"].label == "MATERIALLY_REVISED"


def test_digits_do_not_matter(spark):
    rows = [("a", 1, 2021, "Losses of 12 in 2021", "We lost 5 of 10 items"), ("b", 1, 2022, "Losses of 99 in 2022", "We lost 7 of 11 items")]
    assert run(spark, rows)["b", "a"].similarity == 1.0


def test_siblings_are_ambiguous(spark):
    rows = [("a", 1, 2021, "subject to credit risk", "x"), ("b", 1, 2021, "subject to credit risk", "x"), ("c", 1, 2022, "subject to credit risk", "x")]
    got = run(spark, rows)
    assert got["c", None].label == "AMBIGUOUS" and got["c", None].rejected_id == "b" and got["c", None].review == "y"


@pytest.mark.parametrize("years", [(2021, 2023), (2021,)])
def test_gap_and_single_year_have_no_rows(spark, years):
    assert run(spark, [(f"r{y}", 1, y, "one heading", "") for y in years]) == {}


def test_empty_body(spark):
    got = run(spark, [("a", 1, 2021, "one heading here", ""), ("b", 1, 2022, "one heading here", "")])
    assert got["b", "a"].similarity == 0.7


def test_rewrite_flag(spark):
    old = [(f"o{i}", 1, 2021, f"{chr(97 + i) * 4} topic{chr(97 + i)}", chr(97 + i) * 3 + " " + "y" * 90) for i in range(8)]
    new = [(f"n{i}", 1, 2022, f"{chr(110 + i) * 4} theme{chr(110 + i)}", chr(110 + i) * 3 + " " + "z" * 190) for i in range(4)]
    r = panel(spark, old + new)
    pairs, rest = matching.match_rounds(similarity.edges(similarity.vectors(r)), keep)
    got = matching.structural_rewrites(matching.rows(r, pairs, rest), matching.year_totals(r)).collect()
    assert [(x.cik, x.fiscal_year, x.churn, x.count_ratio) for x in got] == [(1, 2022, 1.0, 0.5)]


@pytest.mark.parametrize(("n", "few"), [(54, 1000), (7, 0)])
def test_rounds_go_on_until_nothing_is_accepted(spark, n, few):
    """Each accepted pair frees the next one: a record's runner-up is the counterpart of the record before."""
    sims = {("c0", "p0"): 0.95}
    for i in range(1, n):
        sims[f"c{i}", f"p{i}"] = 0.95 - i * 0.001
        sims[f"c{i}", f"p{i - 1}"] = 0.95 - (i - 1) * 0.001 - 0.0505
    left, want, rounds = dict(sims), set(), 0
    while True:
        took = []
        for (a, b), s in left.items():
            others = [x for k, x in left.items() if k != (a, b) and (k[0] == a or k[1] == b)]
            if s >= 0.25 and all(s - x >= 0.05 for x in others):
                took.append((a, b))
        if not took:
            break
        rounds += 1
        want |= set(took)
        left = {k: s for k, s in left.items() if k[0] not in {a for a, _ in took} and k[1] not in {b for _, b in took}}
    assert rounds == n and len(want) == n
    edges = spark.createDataFrame([(1, 2022, a, b, s) for (a, b), s in sims.items()], "cik int, fiscal_year int, curr_id string, prev_id string, sim double")
    kept = []

    def keep(df):
        rows = df.collect()
        kept.append(len(rows))
        return spark.createDataFrame(rows, df.schema).coalesce(1)

    pairs, rest = matching.match_rounds(edges, keep, few=few)
    assert {(r.curr_id, r.prev_id) for r in pairs.collect()} == want and rest.count() == 0
    # The edges once, and a handful of rows for each round (in parts that are gathered, pairs come again).
    assert kept[0] == len(sims)
    if not few:
        assert max(kept[1:]) <= n and sum(kept[1:]) <= 20 * n


def test_rounds_of_what_changed_are_rounds_of_all(spark):
    luck = random.Random(2)
    sims = {(f"c{luck.randint(0, 25)}", f"p{luck.randint(0, 25)}"): round(luck.choice([0.1, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.9]) + luck.random() / 50, 4) for _ in range(60)}
    edges = spark.createDataFrame([(1, 2022, a, b, s) for (a, b), s in sims.items()], "cik int, fiscal_year int, curr_id string, prev_id string, sim double")
    got = [matching.match_rounds(edges, lambda df: spark.createDataFrame(df.collect(), df.schema).coalesce(1), few=few) for few in (0, 1000)]
    assert [sorted(map(tuple, x.select("curr_id", "prev_id", "sim").collect())) for x in got[0]] == [sorted(map(tuple, x.select("curr_id", "prev_id", "sim").collect())) for x in got[1]]
