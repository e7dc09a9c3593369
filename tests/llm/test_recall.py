"""The share of similar pairs that the trees of near-dedup find when every node lies deep."""

import random

from pyspark.sql import functions as F

from skyquilt.llm import minhash


def pairs(n, common, own, step):
    """n pairs of texts of the same common words and of own ones, of which every step-th differs in the second of a pair."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        one = [f"c{j}" for j in range(common)] + [f"w{i}x{j}" for j in range(own)]
        two = list(one)
        for at in range(common + step - 1, len(one), step):
            two[at] = f"y{rng.random()}"
        rows += [(2 * i, " ".join(one)), (2 * i + 1, " ".join(two))]
    return rows


def found(spark, n, **arguments):
    """Pairs found; the texts share three quarters of their shingles with all others, and a pair has a similarity of 0.81."""
    got = minhash.near_duplicates(spark.createDataFrame(pairs(n, 200, 40, 8), "doc_id long, text string"), 5, 80, **arguments).collect()
    assert all(r["component_id"] in (r["doc_id"], r["doc_id"] - r["doc_id"] % 2) for r in got)
    return sum(r["component_id"] == r["doc_id"] - 1 for r in got if r["doc_id"] % 2)


def test_documents_in_deep_nodes_get_more_trees(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 8)
    few, enough = found(spark, 400, recall=0.0), found(spark, 400)
    print(few, enough)
    assert few < enough and enough >= 0.98 * 400


def test_shallow_documents_get_no_more_trees(spark):
    rows = spark.createDataFrame(pairs(20, 0, 240, 40), "id long, text string")
    reps = rows.mapInArrow(lambda it: minhash._signed(it, 5), "id long, n long, digest binary, token binary")
    nodes = minhash._nodes(reps, 80, 0.99)
    assert nodes.agg(F.max("tree")).first()[0] < minhash.TREES
