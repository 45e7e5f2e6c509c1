import numpy as np
import pytest

from tidemark.llm import embedding_dedup, queries
from tidemark.llm.common import read_table

SCHEMA = "vec_id bigint, embedding array<float>, copies string, cell int"


def by_hand(ids, vectors, cosine=0.95):
    """Links of every row by its number, and smallest id reached, over all pairs."""
    x = np.array(vectors, np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    parent = list(range(len(x)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = sorted((root(i), root(j)))
        parent[b] = a
    least = {}
    for i in range(len(x)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted((ids[i], int(linked[i].sum()), least[root(i)]) for i in range(len(x)))


def rows_of(df):
    return sorted((r.id, r.n_links, r.component_id) for r in df.collect())


def frame(spark, ids, vectors):
    rows = [(int(i), [float(c) for c in v], "x", 1) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def made(rng, groups, size, noise, alone, dims):
    """Groups of vectors around a direction and vectors on their own, in double precision that a float keeps."""
    base = rng.normal(size=(groups, dims))
    near = np.repeat(base, size, 0) + noise * rng.normal(size=(groups * size, dims))
    x = np.concatenate([near, rng.normal(size=(alone, dims))]).astype(np.float32).astype(float)
    return rng.permutation(len(x)) * 3 + 1, x


def test_small_cells_equal_all_pairs(spark):
    """Several levels, cells, blocks and tasks; distances to borders as the exact rule has them."""
    rng = np.random.default_rng(3)
    ids, x = made(rng, 12, 25, 0.2, 300, 6)
    df = frame(spark, ids, x)
    got = embedding_dedup.near_duplicates(df, "vec_id", "embedding", cell_rows=60, block_rows=16, sample_rows=200, most_cells=6, reach=1.0)
    assert rows_of(got) == by_hand(ids.tolist(), x)


def test_default_reach_finds_nearly_all(spark):
    rng = np.random.default_rng(4)
    ids, x = made(rng, 300, 4, 0.15, 2000, 48)
    want = {r[0]: r for r in by_hand(ids.tolist(), x)}
    got = rows_of(embedding_dedup.near_duplicates(frame(spark, ids, x), "vec_id", "embedding", cell_rows=200, sample_rows=1000))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want.values()) > 1000
    assert all(r[1] <= want[r[0]][1] for r in got)


def test_tight_group_is_compared_in_blocks(spark):
    """A third of all rows are copies near to each other, another third are equal."""
    rng = np.random.default_rng(5)
    ids, x = made(rng, 1, 300, 0.05, 300, 16)
    x = np.concatenate([x, np.repeat(x[:1], 300, 0)])
    ids = np.arange(len(x)) + 10
    got = embedding_dedup.near_duplicates(frame(spark, ids, x), "vec_id", "embedding", cell_rows=64, block_rows=32, sample_rows=128, reach=1.0)
    assert rows_of(got) == by_hand(ids.tolist(), x)


def test_chain_is_one_component(spark):
    angles = np.arange(40) * 0.25
    x = np.stack([np.cos(angles), np.sin(angles)], 1)[:20]
    got = rows_of(embedding_dedup.near_duplicates(frame(spark, range(20), x), "vec_id", "embedding", block_rows=3))
    assert got == [(i, 1 if i in (0, 19) else 2, 0) for i in range(20)]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (9, None), (8, []), (7, [0.0, 0.0]), (6, [None, 1.0]), (5, [nan, 1.0]), (4, [inf, 1.0]),
        (3, [1.0, 0.0]), (2, [2.0]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [-1.0, 0.0]), (12, [1e30, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = embedding_dedup.near_duplicates(df, "vec_id", "embedding").collect()
    want = [(9, 0, 9), (8, 0, 8), (7, 0, 7), (6, 0, 6), (5, 0, 5), (4, 0, 4), (1, 0, 1), (None, 0, None)]
    want += [(3, 3, 2), (3, 3, 2), (2, 3, 2), (12, 3, 2)]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert {r.id: r.kept for r in got} == {9: True, 8: True, 7: True, 6: True, 5: True, 4: True, 3: False, 2: True, None: True, 1: True, 12: False}
    assert embedding_dedup.near_duplicates(df.limit(0), "vec_id", "embedding").collect() == []
    assert all(r.n_links == 0 for r in embedding_dedup.near_duplicates(df.filter("embedding IS NULL"), "vec_id", "embedding").collect())


def test_limit_is_exact(spark):
    """A cosine at the limit is a link, one below it is none."""
    x = [[1.0, 0.0], [0.96875, 0.24803918541230538]]
    at = float(np.float32(x[1][0])) / np.hypot(*np.float32(x[1]).astype(float))
    df = frame(spark, [1, 2], x)
    assert [r[1] for r in rows_of(embedding_dedup.near_duplicates(df, "vec_id", "embedding", cosine=at - 1e-12))] == [1, 1]
    assert [r[1] for r in rows_of(embedding_dedup.near_duplicates(df, "vec_id", "embedding", cosine=at + 1e-12))] == [0, 0]


@pytest.mark.parametrize("size", ["check_s"])
def test_query_equals_all_pairs(spark, size):
    sf_dir = f"/root/testdata/{size}"
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding").toPandas()
    got = queries.op13_embedding_dedup(spark, sf_dir).withColumnRenamed("vec_id", "id")
    assert rows_of(got) == by_hand(table.vec_id.tolist(), np.stack(table.embedding))
