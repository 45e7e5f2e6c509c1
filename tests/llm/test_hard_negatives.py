import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, queries
from tidemark.llm.common import read_table

SCHEMA = "id bigint, label bigint, v array<double>, leaf string, vec int"


def by_hand(ids, labels, x, anchors, positives=5, negatives=5, percent=80):
    ids, labels, x = np.array(ids), np.array(labels), np.array(x, np.int64)
    out = []
    for a in anchors:
        score = x @ x[a]
        order = np.lexsort((ids, -score))
        same = [i for i in order if labels[i] == labels[a] and ids[i] != ids[a]][:positives]
        for p in same:
            fit = (labels[order] != labels[a]) & (percent * score[p] <= 100 * score[order]) & (score[order] <= score[p])
            for rank, n in enumerate(order[fit][:negatives], 1):
                out.append((ids[a], ids[p], rank, ids[n], score[p], score[n]))
    return sorted(tuple(int(c) for c in r) for r in out)


def frame(spark, ids, labels, x):
    rows = [(int(i), int(k), [float(c) for c in v], "x", 1) for i, k, v in zip(ids, labels, x, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def mined(rows, **how):
    """Small leaves, blocks and chunks, so that every part has something to do."""
    index = hard_negatives.build(rows, **({"fanout": 4, "leaf_rows": 40, "sample_rows": 300, "block_rows": 25} | how))
    got = hard_negatives.mine(index, F.col("id") % 10 == 0).collect()
    return index, sorted(tuple(r) for r in got)


@pytest.mark.parametrize("spread", [3, 200])
def test_equals_all_pairs(spark, spread):
    """Clustered vectors with many ties, of different lengths."""
    rng = np.random.default_rng(spread)
    base = rng.integers(-spread, spread + 1, (20, 6))
    x = base[rng.integers(0, 20, 700)] + rng.integers(-2, 3, (700, 6))
    ids, labels = rng.permutation(700), rng.integers(0, 4, 700)
    index, got = mined(frame(spark, ids, labels, x))
    assert len(index.blocks) > 5
    assert got == by_hand(ids, labels, x, [i for i in range(700) if ids[i] % 10 == 0])


def test_siblings_are_ruled_out(spark):
    """In clustered data a ring around a query meets few leaves, and those that are left out hold no answer."""
    rng = np.random.default_rng(1)
    base = rng.integers(-300, 300, (16, 8))
    x = base[np.arange(800) % 16] + rng.integers(-5, 6, (800, 8))
    index = hard_negatives.build(frame(spark, np.arange(800), np.zeros(800), x), fanout=4, leaf_rows=60, sample_rows=800)
    tree, q = index.tree, x[:50].astype(float)
    points = np.concatenate([q, np.zeros((50, 1))], 1)
    leaf = tree.deal(tree.lifted(x.astype(float)))
    scores = q @ x.T
    least = np.sort(scores, 1)[:, -5]
    base2 = (q**2).sum(1) + tree.radius2
    found = tree.may_answer(points, np.zeros(50), np.sqrt(base2 - 2 * least))
    assert np.mean([len(f) for f in found]) < 0.5 * len(index.blocks)
    for i in range(50):
        assert set(leaf[scores[i] >= least[i]]) <= set(found[i].tolist())
    # Rows that are all too similar lie in the ring's hole.
    hole = tree.may_answer(points, np.full(50, 4 * np.sqrt(tree.radius2)), np.full(50, 9 * np.sqrt(tree.radius2)))
    assert all(len(f) == 0 for f in hole)


def test_one_leaf_with_a_third_of_all_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 100, (400, 5))
    x[:150] = x[0]
    ids, labels = np.arange(400), np.arange(400) % 3
    _, got = mined(frame(spark, ids, labels, x))
    assert got == by_hand(ids, labels, x, range(0, 400, 10))


def test_edge_rows(spark):
    nan = float("nan")
    rows = [
        (0, 1, [4.0, 0.0]), (1, 1, [4.0]), (1, 1, [4.0]), (2, 2, [4.0, 0.0]), (3, 2, [3.5, 9.0]), (4, 2, [3.0, 0.0]), (None, 1, [9.0, 9.0]),
        (5, None, [4.0, 0.0]), (6, 2, None), (7, 2, []), (8, 2, [nan, 4.0]), (9, 2, [None, 4.0]), (10, 7, [1.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    used = hard_negatives.usable(df, "id", "label", "v")
    assert mined(used)[1] == [(0, 1, 1, 2, 16, 16), (0, 1, 2, 3, 16, 14)]
    assert mined(used.limit(0))[1] == []
    assert mined(used.filter("label = 1"))[1] == []
    with pytest.raises(ValueError):
        hard_negatives.build(used.withColumn("v", F.transform("v", lambda x: x * 1e7)))


@pytest.mark.parametrize("size", ["sf0.1"])
def test_query_equals_all_pairs(spark, size):
    sf_dir = f"/root/testdata/{size}"
    t = read_table(spark, sf_dir, "embeddings").toPandas()
    label = np.where(t.vec_id % 7 == 0, (t.label + 1) % 10, t.label)
    x = np.floor(256 * np.stack(t.embedding).astype(float)).astype(int)
    got = queries.op11_hard_negatives(spark, sf_dir)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert got.columns == list(columns)
    want = by_hand(t.vec_id, label, x, np.flatnonzero(t.vec_id % 100 == 0))
    assert sorted(tuple(r) for r in got.collect()) == want
