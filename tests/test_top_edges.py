import random

import pytest

from test_blocks import vectors
from test_prefixes_and_ranks import some_rows
from textpanel.operators import matching, similarity

SCHEMA = "cik int, fiscal_year int, curr_id string, prev_id string, sim double"


def flat(df, *columns):
    return sorted(tuple(x) for x in df.select("curr_id", "prev_id", *columns).collect())


def best(rest, side):
    out = {}
    for x in rest.collect():
        out[x[f"{side}_id"]] = max(out.get(x[f"{side}_id"], (0.0, "")), (x.sim, x["prev_id" if side == "curr" else "curr_id"]))
    return out


@pytest.mark.parametrize("most", [2, 8])
def test_rounds_from_first_edges_are_those_from_all(spark, tmp_path, most):
    v = vectors(spark, some_rows(), tmp_path)
    every = similarity.edges_of(v, 0.05).cache()
    top = similarity.top_edges_of(v, 0.05, most).cache()
    a, b = top.count(), every.count()
    assert a < b and set(flat(top, "sim")) <= set(flat(every, "sim"))
    asked = []
    want, got = matching.match_rounds(every, lambda df: df.localCheckpoint()), matching.match_rounds_of_top(top, lambda: asked.append(1) or every, lambda df: df.localCheckpoint(), most)
    assert flat(got[0], "sim") == flat(want[0], "sim")
    assert all(best(got[1], side) == best(want[1], side) for side in ("curr", "prev"))


def test_records_that_lost_their_first_edges_are_looked_at_anew(spark):
    luck = random.Random(4)
    near = lambda i, j: 0.99 - 0.09 * abs(i - j) + luck.random() / 1000
    rows = [(1, 2022, f"c{i}", f"p{j}", near(i, j)) for i in range(9) for j in range(9) if near(i, j) > 0.2]
    # What is left of x when all others are taken lies beyond its first two.
    rows += [(1, 2022, "x", f"p{j}", 0.7 - j / 100) for j in range(4)] + [(1, 2022, "x", "q", 0.4)]
    first = {id(r) for r in sorted((r for r in rows if r[2] == "x"), key=lambda r: -r[4])[:2]}
    top = [(*r, r[2] == "x", False) for r in rows if r[2] != "x" or id(r) in first]
    asked, every = [], spark.createDataFrame(rows, SCHEMA)
    found, _ = matching.match_rounds_of_top(spark.createDataFrame(top, f"{SCHEMA}, curr_top boolean, prev_top boolean"), lambda: asked.append(1) or every, lambda df: df.localCheckpoint(), 2)
    assert asked and ("x", "q") in {(x.curr_id, x.prev_id) for x in found.collect()}
